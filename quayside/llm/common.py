"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

#: Rows of a small side that may be broadcast; callers count before they hint.
BROADCAST_ROWS = 100_000

#: Texts differ in length by orders of magnitude: batches sent to Python workers
#: are bounded by bytes, and by fewer rows than Spark's default.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def on_workers(spark: SparkSession) -> SparkSession:
    """Bound the batches of Python workers, and let these import this package from
    where the driver has it (no change where executors have it installed).  The
    session keeps both from then on: plans run after the call that made them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of an input table; other columns never enter a plan."""
    return on_workers(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later passes
    start from storage, so a lost executor never replays what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def word_count(text: Column) -> Column:
    """Words of a text as BIGINT; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_result(df: DataFrame, row: str, **new: Column) -> DataFrame:
    """Unpack the struct column ``row`` (the caller's own columns) and add the
    result columns; on a name clash the result column wins."""
    taken = {n.lower() for n in new}
    keep = [F.col(f"{row}.`{f.name}`") for f in df.schema[row].dataType.fields if f.name.lower() not in taken]
    return df.select(*keep, *[c.alias(n) for n, c in new.items()])


def set_aside(df: DataFrame, *taken: str) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``df`` with its columns of the names ``taken`` under other names, so that an
    operator's own columns can't clash with them; the present name of every
    column; and what gives a result its columns back, in their order."""
    free = (n for i in range(len(df.columns) + len(taken) + 1) if (n := f"__own{i}") not in {c.lower() for c in df.columns} | set(taken))
    now = {c: next(free) if c.lower() in taken else c for c in df.columns}
    return (df.withColumnsRenamed({c: n for c, n in now.items() if c != n}), now,
            lambda out: out.select(*[F.col(f"`{n}`").alias(c) for c, n in now.items()]))
