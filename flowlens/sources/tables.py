"""Readers and the publish sink.

The source analytics are materialized views.  Here an analytic is a lazy DataFrame;
``publish`` writes it: a new version beside the old one, then a switch of the name, so a
refresh that fails leaves the old result readable.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, source: str, name: str) -> DataFrame:
    """One base table: ``{source}/{name}.parquet`` in a folder or store, or the catalog
    table ``{schema}.{name}`` if ``source`` is ``catalog:{schema}``.

    Every call lists the files anew, so appended or rewritten files are seen.
    """
    if source.startswith("catalog:"):
        schema = source.removeprefix("catalog:")
        return spark.table(f"{schema}.{name}" if schema else name)
    return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


_VERSION = re.compile(r"v\d{20}_[0-9a-f]{8}")


def _store(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/")).getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions below a published folder, newest first.

    A version is complete once its ``_SUCCESS`` marker, the last file of the commit, is there.
    """
    store, at = _store(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    if not store.exists(at(path.rstrip("/"))):
        return []
    names = sorted((s.getPath().getName() for s in store.listStatus(at(path.rstrip("/")))), reverse=True)
    return [n for n in names if _VERSION.fullmatch(n) and store.exists(at(f"{path.rstrip('/')}/{n}/_SUCCESS"))]


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the latest complete version below a published folder."""
    for name in _versions(spark, path):
        return f"{path.rstrip('/')}/{name}"
    raise FileNotFoundError(f"no published version below {path}")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest published version of a folder."""
    return spark.read.parquet(current_version(spark, path))


def publish(df: DataFrame, *, path: str | None = None, table: str | None = None,
            partition_by: Sequence[str] | None = None, mode: str = "replace", keep: int | None = None) -> None:
    """Write an analytic result (a refreshed view); exactly one of ``path`` and ``table``.

    ``path``: the result becomes a new version folder below it; readers go through
    ``read_published``, which takes the latest complete one.  ``table``: the result becomes
    a new catalog table, and the view ``table`` is pointed at it last (replacing a view is
    one catalog change).  Either way a failed refresh leaves the old version in place.

    ``mode`` says what to do with what stands under the name: ``replace`` refreshes a published
    result; ``create`` refuses if there is one; ``takeover`` also takes the name of a plain
    table, which is renamed to ``{table}_before_{version}`` (never dropped) once the new version is written, and
    renamed back if the view cannot be created.  A plain table under another mode is refused before anything is written.
    ``keep`` removes all but that many newest versions after the switch; without it they stay.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if mode not in ("replace", "create", "takeover"):
        raise ValueError("mode is replace, create or takeover")
    if keep is not None and keep < 1:
        raise ValueError("keep at least one version")
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        if mode == "create" and _versions(spark, path):
            raise ValueError(f"{path} is published already")
        writer.save(f"{path.rstrip('/')}/{version}")
        for old in _versions(spark, path)[keep:] if keep else []:
            _store(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{old}"), True)
        return
    found = spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None
    if found and mode == "create":
        raise ValueError(f"{table} exists already")
    if found and found != "VIEW" and mode != "takeover":
        raise ValueError(f"{table} is a table; mode='takeover' renames it and takes its name")
    staged = f"{table}_{version}"
    writer.saveAsTable(staged)
    before = f"{table}_before_{version}"
    if found and found != "VIEW":
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {staged}")
    except Exception:
        if found and found != "VIEW":
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
        raise
    if keep:
        schema, _, name = table.rpartition(".")
        listed = spark.catalog.listTables(schema or None, f"{name}_v*")
        own = sorted((t.name for t in listed if _VERSION.fullmatch(t.name.removeprefix(f"{name}_")) and t.name.startswith(f"{name}_")), reverse=True)
        for old in own[keep:]:
            spark.sql(f"DROP TABLE {schema}.{old}" if schema else f"DROP TABLE {old}")
