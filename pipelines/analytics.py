"""The six analytics and two reports on them as declarative materialized views.

``spark-pipelines run --spec pipelines/spark-pipeline.yml`` refreshes them in order of their dependencies:
the platform keeps the old result until the new one is written.  The logical tables (README, "Inputs")
are read from the schema named by ``flowlens.source.schema`` in the session (default: the current one).
``publish`` does the same for a single result without a pipeline.
"""

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from flowlens.operators.durations import sla_summary, state_durations, state_periods
from flowlens.operators.funnel import daily_funnel
from flowlens.operators.growth import monthly_growth
from flowlens.operators.paths import event_paths
from flowlens.operators.purchases import first_vs_repeat
from flowlens.operators.transitions import forward_conversions, stage_responsible


def source(name: str) -> DataFrame:
    spark = SparkSession.active()
    schema = spark.conf.get("flowlens.source.schema", "")
    return spark.table(f"{schema}.{name}" if schema else name)


@dp.materialized_view(comment="Who was responsible at each stage change")
def followup_responsible_by_sector() -> DataFrame:
    return stage_responsible(source("followup_logs"), source("followups"), source("users"))


@dp.materialized_view(comment="Seconds each sale spent in each stage")
def followups_sector_sla() -> DataFrame:
    return state_durations(source("followup_logs"), source("followups"), source("users"))


@dp.materialized_view(comment="Each completed purchase as first-time or repeat")
def user_first_vs_repeat_purchase() -> DataFrame:
    return first_vs_repeat(source("followups"), source("operators"), source("users"), source("client_ids"))


@dp.materialized_view(comment="Monthly growth on a month spine")
def monthly_growth_metrics() -> DataFrame:
    growth = monthly_growth(source("users"), source("leads"), source("contracts"))
    return growth.toDF(*[c.lower().replace(" ", "_") for c in growth.columns])


@dp.materialized_view(comment="Daily funnel measures per covenant and platform")
def user_funnel_daily_metrics() -> DataFrame:
    return daily_funnel(source("users"), source("leads"), source("events"), source("followups"), source("followup_logs"))


@dp.materialized_view(comment="Edge list of the event paths")
def user_events_behavior_sankey() -> DataFrame:
    return event_paths(source("events"), source("users"))


@dp.materialized_view(comment="Periods of the sales in their stages")
def followup_stage_periods() -> DataFrame:
    return state_periods(source("followup_logs"), source("followups"), source("users"))


@dp.materialized_view(comment="Service levels per covenant and stage")
def followup_stage_service_levels() -> DataFrame:
    return sla_summary(SparkSession.active().table("followup_stage_periods"))


@dp.materialized_view(comment="Stage changes and forward steps per responsible")
def responsible_conversions() -> DataFrame:
    return forward_conversions(SparkSession.active().table("followup_responsible_by_sector"))
