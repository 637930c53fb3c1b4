"""Decoding a feed by the schema id of each message.

A message is framed as magic byte 0, a 4-byte big-endian schema id and the
payload.  The registry is a small table ``(schema_id, subject, version,
schema)`` that maps ids to the schema a message was written with.  Payloads
are read with their own (writer) schema and promoted to the subject's newest
(reader) schema: a column may have been added, if it may be NULL, and a type may
have grown; a column that was dropped or has changed its type is not compatible,
and messages of such an id go to the dead letters, as do those with another
magic byte, with an id that isn't registered, or with a payload that their
schema doesn't fit.

All ids are decoded in one pass over the feed, one branch for each id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.schema_ops import can_widen

MAGIC = 0
_CORRUPT = "__corrupt"


@dataclass(frozen=True)
class Registered:
    schema_id: int
    subject: str
    version: int
    schema: T.StructType


def load(rows: DataFrame) -> list[Registered]:
    """The registry from its table; ``schema`` is a DDL string or a JSON schema."""
    out = []
    for r in rows.select("schema_id", "subject", "version", "schema").collect():      # ids, not messages
        text = r.schema.strip()
        kind = T._parse_datatype_json_string(text) if text.startswith("{") else T._parse_datatype_string(text)
        out.append(Registered(r.schema_id, r.subject, r.version, kind))
    return sorted(out, key=lambda x: x.schema_id)


def incompatible(writer: T.StructType, reader: T.StructType) -> list[str]:
    """Why rows of ``writer`` can't be read as ``reader`` (empty: they can)."""
    had = {f.name: f for f in writer.fields}
    out = [f"dropped {n}" for n in had if n not in {f.name for f in reader.fields}]
    for f in reader.fields:
        if f.name not in had:
            if not f.nullable:
                out.append(f"added {f.name}, which may not be NULL")
        elif not can_widen(had[f.name].dataType, f.dataType):
            out.append(f"retyped {f.name}: {had[f.name].dataType.simpleString()} to {f.dataType.simpleString()}")
        elif had[f.name].nullable and not f.nullable:
            out.append(f"{f.name} may no longer be NULL")
    return out


def reader_of(registry: list[Registered], subject: str) -> T.StructType:
    mine = [r for r in registry if r.subject == subject]
    if not mine:
        raise ValueError(f"no schema is registered for {subject}")
    return max(mine, key=lambda r: r.version).schema


def frame(schema_id: Column, payload: Column) -> Column:
    return F.concat(F.unhex(F.lit(f"{MAGIC:02x}")), F.unhex(F.lpad(F.hex(schema_id.cast("long")), 8, "0")), F.encode(payload, "UTF-8"))


def _branch(payload: Column, writer: T.StructType, reader: T.StructType) -> Column:
    """The payload by its writer's schema, under the reader's columns and types;
    NULL where it doesn't fit."""
    read = T.StructType([*writer.fields, T.StructField(_CORRUPT, T.StringType())])
    row = F.from_json(payload, read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"})
    had = {f.name: f for f in writer.fields}
    needed = [row[f.name].isNotNull() for f in writer.fields if not f.nullable]
    fine = row.isNotNull() & row[_CORRUPT].isNull()
    for n in needed:
        fine = fine & n
    cols = [(row[f.name].cast(f.dataType) if f.name in had else F.lit(None).cast(f.dataType)).alias(f.name) for f in reader.fields]
    return F.when(fine, F.struct(*cols))


def decode(feed: DataFrame, registry: list[Registered], subject: str, framed_col: str = "framed") -> tuple[DataFrame, DataFrame]:
    """``(rows, dead)`` of a subject's framed messages: the feed's other columns with
    ``schema_id`` and the reader's columns; and those that can't be read, with
    ``schema_id`` and ``reason``.  NULL messages are in neither."""
    reader = reader_of(registry, subject)
    mine = [r for r in registry if r.subject == subject]
    fit = {r.schema_id: not incompatible(r.schema, reader) for r in mine}
    b = F.col(framed_col)
    other = [c for c in feed.columns if c != framed_col]
    parsed = feed.filter(b.isNotNull()).select(
        *other, F.conv(F.hex(F.substring(b, 1, 1)), 16, 10).cast("int").alias("__magic"),
        F.when(F.length(b) >= 5, F.conv(F.hex(F.substring(b, 2, 4)), 16, 10).cast("long")).alias("schema_id"),
        F.decode(F.expr(f"substring(`{framed_col}`, 6)"), "UTF-8").alias("__payload"))
    sid, row = F.col("schema_id"), F.lit(None).cast(reader)
    for r in mine:
        if fit[r.schema_id]:
            row = F.when(sid == r.schema_id, _branch(F.col("__payload"), r.schema, reader)).otherwise(row)
    reason = (F.when(F.col("__magic").isNull() | (F.col("__magic") != MAGIC) | sid.isNull(), "bad_frame")
              .when(~F.coalesce(sid.isin([r.schema_id for r in mine]), F.lit(False)), "unknown_schema")
              .when(sid.isin([i for i, ok in fit.items() if not ok]), "incompatible_schema")
              .when(F.col("__row").isNull(), "bad_payload"))
    done = parsed.withColumn("__row", row).withColumn("reason", reason)
    rows = done.filter(F.col("reason").isNull()).select(*other, "schema_id", *[F.col(f"__row.`{f.name}`").alias(f.name) for f in reader.fields if f.name not in other])
    dead = done.filter(F.col("reason").isNotNull()).select(*other, "schema_id", "reason")
    return rows, dead
