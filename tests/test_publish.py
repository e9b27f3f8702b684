"""Sink and contract helpers."""

import os
import tempfile

import pytest

from flowlens import publish, read_published, read_table
from flowlens.functions.semantics import assert_unique
from flowlens.plans import catalog
from flowlens.sources import adapters as A

SF = "/root/testdata/sf0.001"


def test_publish_parquet_roundtrip(spark):
    df = catalog.q_monthly_growth(spark, SF)
    target = os.path.join(tempfile.mkdtemp(prefix="flowlens-publish-"), "monthly_growth")
    publish(df, path=target)
    publish(df.limit(3), path=target)             # a refresh
    assert read_published(spark, target).count() == 3
    publish(df, path=target)
    back = read_published(spark, target)
    assert sorted(back.collect()) == sorted(df.collect())
    assert back.columns == df.columns            # names with spaces survive


def test_failed_refresh_leaves_the_old_version(spark):
    target = os.path.join(tempfile.mkdtemp(prefix="flowlens-publish-"), "view")
    bad = spark.range(10).selectExpr("IF(id = 9, raise_error('broken source'), id) AS n")
    publish(spark.range(5).selectExpr("id AS n"), path=target)
    with pytest.raises(Exception, match="broken source"):
        publish(bad, path=target)
    assert read_published(spark, target).count() == 5
    spark.sql("CREATE DATABASE IF NOT EXISTS pub LOCATION '" + tempfile.mkdtemp(prefix="flowlens-db-") + "'")
    publish(spark.range(5).selectExpr("id AS n"), table="pub.view")
    with pytest.raises(Exception, match="broken source"):
        publish(bad, table="pub.view")
    assert spark.table("pub.view").count() == 5
    publish(spark.range(7).selectExpr("id AS n"), table="pub.view")
    assert spark.table("pub.view").count() == 7
    assert read_table(spark, "catalog:pub", "view").count() == 7


def test_readers_see_appended_and_rewritten_files(spark):
    folder = tempfile.mkdtemp(prefix="flowlens-read-")
    spark.range(10).write.parquet(f"{folder}/t.parquet")
    assert read_table(spark, folder, "t").count() == 10
    spark.range(5).write.mode("append").parquet(f"{folder}/t.parquet")
    assert read_table(spark, folder, "t").count() == 15
    spark.range(3).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert read_table(spark, folder, "t").count() == 3


def test_publish_needs_one_target(spark):
    with pytest.raises(ValueError):
        publish(spark.range(1), path=None, table=None)


def test_assert_unique(spark):
    assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "users")


def test_operators_can_assert_unique_users(spark):
    from flowlens import first_vs_repeat, stage_responsible, state_durations
    from tests.conftest import FOLLOWUPS_SCHEMA, LOGS_SCHEMA, USERS_SCHEMA, followup, ts

    users = spark.createDataFrame([("u1", "A", None, False, None), ("u1", "B", None, False, None)],
                                  USERS_SCHEMA)
    logs = spark.createDataFrame([(1, 1, ts("2024-09-01"), "Stage Responsible", None, "ann"), (2, 1, ts("2024-09-02"), "Sector", None, "SALES")], LOGS_SCHEMA)
    fu = spark.createDataFrame([followup(1, "u1", "2024-08-31", "2024-09-03", status="Finalizado")], FOLLOWUPS_SCHEMA)
    ids = spark.createDataFrame([("u1", "c")], "user_id string, client_key string")
    ops = spark.createDataFrame([], "seller_id long, seller_name string")
    for call in (lambda users: state_durations(logs, fu, users, assert_users_unique=True),
                 lambda users: stage_responsible(logs, fu, users, assert_users_unique=True),
                 lambda users: first_vs_repeat(fu, ops, users, ids, assert_users_unique=True)):
        assert len(call(users.limit(1)).collect()) == 1
        late = call(users)                      # no job runs here
        with pytest.raises(Exception, match=r"users: key \['user_id'\] is not unique: u1"):
            late.collect()


def test_modes_of_publish(spark):
    """A plain table is refused, or renamed and replaced; old versions go only when told."""
    spark.sql("CREATE DATABASE IF NOT EXISTS modes LOCATION '" + tempfile.mkdtemp(prefix="flowlens-db-") + "'")
    spark.range(3).write.saveAsTable("modes.sla")
    with pytest.raises(ValueError, match="takeover"):
        publish(spark.range(5), table="modes.sla")
    assert [t.name for t in spark.catalog.listTables("modes")] == ["sla"]            # nothing was written
    with pytest.raises(Exception, match="broken source"):
        publish(spark.range(5).selectExpr("raise_error('broken source') AS id"), table="modes.sla", mode="takeover")
    assert spark.table("modes.sla").count() == 3
    publish(spark.range(5), table="modes.sla", mode="takeover")
    assert spark.table("modes.sla").count() == 5
    before = [t.name for t in spark.catalog.listTables("modes") if "_before_" in t.name]
    assert len(before) == 1 and spark.table(f"modes.{before[0]}").count() == 3
    publish(spark.range(6), table="modes.sla")
    publish(spark.range(7), table="modes.sla", keep=1)
    names = [t.name for t in spark.catalog.listTables("modes")]
    assert spark.table("modes.sla").count() == 7 and len(names) == 3 and before[0] in names
    with pytest.raises(ValueError, match="exists"):
        publish(spark.range(1), table="modes.sla", mode="create")
    publish(spark.range(2), table="modes.fresh", mode="create")
    assert spark.table("modes.fresh").count() == 2

    target = os.path.join(tempfile.mkdtemp(prefix="flowlens-publish-"), "view")
    for n in (1, 2, 3):
        publish(spark.range(n), path=target)
    with pytest.raises(ValueError, match="published"):
        publish(spark.range(1), path=target, mode="create")
    publish(spark.range(4), path=target, keep=2)
    assert len(os.listdir(target)) == 2 and read_published(spark, target).count() == 4
    for wrong in ({"mode": "append"}, {"keep": 0}):
        with pytest.raises(ValueError):
            publish(spark.range(1), path=target, **wrong)


def test_pipeline_file_defines_the_views_and_their_dependencies(spark):
    """The declarative pipeline, read as its runner reads it, with every query built on tables (no server)."""
    import runpy

    from pyspark.pipelines.graph_element_registry import GraphElementRegistry, graph_element_registration_context

    class Found(GraphElementRegistry):
        def __init__(self):
            self.outputs, self.flows = {}, {}

        def register_output(self, output):
            self.outputs[output.name] = output

        def register_flow(self, flow):
            self.flows[flow.target] = flow

        def register_sql(self, sql_text, file_path):
            raise AssertionError("no SQL files")

    found = Found()
    with graph_element_registration_context(found):
        runpy.run_path(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "pipelines", "analytics.py"))
    assert len(found.outputs) == 9 and set(found.outputs) == set(found.flows)

    for name, df in {"users": A.users(spark, SF), "followups": A.customer_followups(spark, SF), "followup_logs": A.event_logs(spark, SF),
                     "leads": A.leads(spark, SF), "events": A.app_events(spark, SF), "operators": A.operators(spark, SF),
                     "client_ids": A.client_ids(spark, SF), "contracts": A.contracts(spark, SF)}.items():
        df.createOrReplaceTempView(name)
    order = [*[n for n in found.flows if n not in ("followup_stage_service_levels", "responsible_conversions")],
             "followup_stage_service_levels", "responsible_conversions"]
    for name in order:
        found.flows[name].func().createOrReplaceTempView(name)
    assert spark.table("followups_sector_sla").count() == spark.table("followups").join(
        spark.table("followup_logs"), "followup_id", "left_semi").count()
    assert {"covenant", "state", "p50_duration_seconds"} <= set(spark.table("followup_stage_service_levels").columns)
    assert spark.table("followup_stage_service_levels").count() > 0
    assert all(" " not in c for c in spark.table("monthly_growth_metrics").columns)
