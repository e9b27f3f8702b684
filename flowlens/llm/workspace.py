"""Shared-folder tables, process caches and pickling for the llm operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

LARGE = ("latest ", "codec ", "names ", "count ", "encode ")   # caches that one operator's tasks keep for each other
BATCH_ROWS = 256   # texts handed to Python at once by the jobs that write intermediate tables
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def by_value(module_name: str) -> None:
    """Ship a module's functions inside the task, not by module name."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def process_cache(name: str, make):
    """One object per worker process, kept across the tasks it runs."""
    store = sys.modules.setdefault("_flowlens_process", types.ModuleType("_flowlens_process")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def latest_in_process(name: str, key, make):
    """One object per worker process and name: a new key replaces the old object."""
    store = process_cache(f"latest {name}", dict)
    if store.get("key") != key:
        store.clear()
        store["value"] = make()
        store["key"] = key
    return store["value"]


def free_names(wanted: list[str], taken: list[str]) -> list[str]:
    """``wanted`` column names, with underscores appended until none clashes (in any case) with ``taken`` or each other."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Return this worker's unused memory to the system: what a scan needed is not kept by an idle worker."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):   # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def forget_others(*keep: str) -> None:
    """Drop the models and remembered words that other operators keep in this worker, all but the names in ``keep``."""
    store = sys.modules.get("_flowlens_process")
    dropped = [k for k in (store.__dict__ if store else {}) if k.startswith(LARGE) and k not in keep]
    for key in dropped:
        del store.__dict__[key]
    if dropped:
        give_back()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` of the session.

    Only where it is unset and the master is local (tests) is a scratch folder chosen.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + process_cache("scratch", lambda: tempfile.mkdtemp(prefix="flowlens-"))
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals out both sides, whatever Spark expects of their size.

    A side that grows with the input is never gathered in the driver to be broadcast: its rows
    take many times the bytes of the Parquet file that Spark's threshold is held against.
    """
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see which shuffles no query refers to any more.

    Listeners hold the last query that ended until another one does: an empty one takes its place.
    """
    spark.range(0).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bound_batches(spark: SparkSession) -> str:
    """From here on the session's jobs hand Python at most ``BATCH_ROWS`` rows at once: less memory in the JVM and in the workers.

    Returns the former setting.
    """
    old = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(BATCH_ROWS, int(old)) if int(old) > 0 else BATCH_ROWS))
    return old


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """``bound_batches`` for the jobs within it."""
    old = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, old)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage; a lost executor costs nothing that was written.  The shuffle files of
    the finished query are let go: Spark's cleaner removes them once the driver's garbage
    collector has seen that nothing refers to them.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


by_value(__name__)
