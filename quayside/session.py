"""Session construction and shared-storage helpers.

The engine never decides where a cluster keeps intermediate data: scratch
tables and checkpoints go under ``spark.checkpoint.dir`` as the session
names it.  Only when that setting is absent (unit tests, a laptop) do we
create a folder of our own and register it.
"""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (the source data is UTC),
# AQE for runtime re-planning / skew splitting, ANSI arithmetic, dynamic
# partition overwrite for keyed rewrites of partitioned tables.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "quayside", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the session the platform gives."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "16g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All timestamps in this engine are UTC instants; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Bytes that a task reads at most (a file's row group, or shuffled rows) while a stored table is written.
TASK_BYTES = 16 << 20


def _bytes(size: str) -> int:
    """A byte size as settings state it (``128m``, ``134217728b``)."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", size.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


@contextmanager
def small_tasks(spark: SparkSession, input_bytes: int | None):
    """While a stored table is written: scans and shuffles go by tasks of at most
    ``TASK_BYTES``, and shuffles begin with as many partitions as the input asks for
    (AQE joins small ones), so that neither the hash tables of partial aggregates nor
    the sorts of joins grow with the input, however few partitions the session names."""
    files, advised, first = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                             "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    set_before = {k: spark.conf.get(k, None) for k in (files, advised, first)}
    for k in (files, advised):
        spark.conf.set(k, str(min(TASK_BYTES, _bytes(spark.conf.get(k)))))
    partitions = max(int(set_before[first] or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(first, str(max(partitions, math.ceil(4 * (input_bytes or 0) / TASK_BYTES))))
    try:
        yield
    finally:
        for k, v in set_before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def small_scans(spark: SparkSession, most: int):
    """While a stream is started: its tasks read at most ``most`` bytes of a file."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(min(most, _bytes(spark.conf.get(name)))))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (created for local runs only)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
