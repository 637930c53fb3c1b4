"""Importance resampling of documents towards a target distribution.

A document's features are its runs of one to ``runs`` consecutive words, each
counted in the bucket that its bytes' CRC-32 gives.  Where the target's texts
use a bucket more than the documents do, the bucket has a positive gain; a
document's weight is the mean gain of its features.  Weight plus keyed Gumbel
noise orders the documents, and the highest are drawn: a sample without
replacement whose chances follow the weights, alike in every run.

Words come from an untrained regular-expression split, which returns each word
with its offsets in the lower-cased text.  A window of n words is the pair
(start of the first, end of the last); its bytes are those of its words, one
space in each gap, whatever the text has there.  No word holds a blank, so the
split runs once for each different stretch between blanks that a task meets.

One pass over the texts stores each document's buckets; histograms, gains and
weights are then sums over small numbers.  The gains, one number for each
bucket, are all that the driver ever holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from quayside.llm.common import on_workers, stored
from quayside.operators.ranking import global_rank

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
RUNS = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
MEMO = 200_000          # stretches a task remembers
MEMO_CHARS = 64         # longer ones are split each time
PIECE = 1 << 20         # characters of a text that are split into stretches at a time


class _Split(dict):
    """Stretch of text without blanks -> its words as ((CRC-32, bytes after a space), ...)."""

    def __init__(self):
        super().__init__()
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)

    def words(self, stretch: str) -> tuple:
        out = []
        for _, (start, end) in self.split.pre_tokenize_str(stretch):
            word = stretch[start:end].encode()
            out.append((crc32(word), b" " + word))
        return tuple(out)

    def __missing__(self, stretch: str) -> tuple:
        found = self.words(stretch)
        if len(stretch) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[stretch] = found
        return found


def _stretches(text: str) -> Iterator[list[str]]:
    """The text between blanks, lists of about ``PIECE`` characters at a time."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split(" ")
        at = end


def window_hashes(text: str | None, runs: int, memo: _Split) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of every window of 1 to ``runs`` words."""
    if not text:
        return 0, np.empty(0, np.uint32)
    low = text.encode().lower().decode()        # bytes.lower changes A-Z alone
    n, out, tail = 0, [], []
    for part in _stretches(low):
        new = list(chain.from_iterable(map(memo.__getitem__, part)))
        n += len(new)
        words = tail + new                      # windows that begin in the part before
        hashes = [c for c, _ in words]
        out.append(np.array(hashes[len(tail):], np.uint32))
        for k in range(1, runs):
            hashes = [crc32(b, c) for (_, b), c in zip(words[k:], hashes, strict=False)]
            # a window of k + 1 words is new if its last word is: the first of these starts k words before it
            out.append(np.array(hashes[max(0, len(tail) - k):], np.uint32))
        tail = words[max(0, len(words) - runs + 1):] if runs > 1 else []
    return n, np.concatenate(out)


FEATURES = "n_words long, n_features long, buckets array<int>"


def features(docs: DataFrame, row: Column, text_col: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """``(row, n_words, n_features, buckets)``: the struct ``row`` carried along, and
    the bucket of every window (repeats kept).  NULL and empty texts have none."""
    on_workers(docs.sparkSession)
    frame = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Split()
        for b in batches:
            n_words, sizes, found = [], [0], []
            for text in b.column(1).to_pylist():
                n, h = window_hashes(text, runs, memo)
                n_words.append(n)
                sizes.append(len(h))
                found.append((h % np.uint32(buckets)).astype(np.int32))
            offsets = np.cumsum(sizes)
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(sizes[1:], pa.int64()), lists],
                ["row", "n_words", "n_features", "buckets"])

    out = T.StructType([frame.schema["row"], *T._parse_datatype_string(FEATURES).fields])
    return frame.mapInArrow(run, out)


def histogram(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: features in each bucket; a task sends at most one row for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` of every bucket, from the two histograms: floor(1000 * ln)
    of its share of the target over its share of the documents, one added to
    every bucket."""
    none = F.lit(0).cast("long")
    both = (raw.select("bucket", F.col("n").alias("held"), none.alias("aimed"))
            .unionByName(target.select("bucket", none.alias("held"), F.col("n").alias("aimed")))
            .unionByName(raw.sparkSession.range(buckets).select(F.col("id").alias("bucket"), none.alias("held"), none.alias("aimed")))
            .groupBy("bucket").agg(F.sum("held").alias("held"), F.sum("aimed").alias("aimed")))
    all_ = both.agg((F.sum("held") + buckets).cast("double").alias("all_held"), (F.sum("aimed") + buckets).cast("double").alias("all_aimed"))
    share = ((F.col("aimed") + 1).cast("double") * F.col("all_held")) / ((F.col("held") + 1).cast("double") * F.col("all_aimed"))
    return both.crossJoin(all_).select("bucket", F.floor(F.lit(1000.0) * F.log(share)).cast("long").alias("gain"))     # one row


def _weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with the floored mean gain of each row's features (0 without any)."""
    handle = found.sparkSession.sparkContext.broadcast(gain)             # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = handle.value
        for b in batches:
            lists = b.column(3)
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(g[lists.flatten().to_numpy()])])
            ends -= ends[0]
            n = np.diff(ends)
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(1, n)      # numpy floors
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(weight, pa.int64())],
                                             ["row", "n_words", "n_features", "weight"])

    out = T.StructType([f for f in found.schema.fields if f.name != "buckets"] + [T.StructField("weight", T.LongType())])
    return found.select("row", "n_words", "n_features", "buckets").mapInArrow(run, out)


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))): u in (0, 1) from the first 32 bits of sha256(seed:key)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             carry: list[str] | None = None, percent: int = PERCENT, min_words: int = MIN_WORDS, runs: int = RUNS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with ``n_words, n_features, weight, score, rank``.

    ``rank`` is 1, 2, 3 ... for the floor(percent * N / 100) highest scores among
    the N rows of at least ``min_words`` words (ties to the smaller id, NULL ids
    last, then to the smaller weight and feature count), else NULL: the sample is
    the rows whose rank is not NULL.  ``carry`` names the columns to keep (the id
    alone by default); a result column wins over a carried one of its name.

    NULL, empty and blank texts have no features, weight 0 and are never drawn
    unless ``min_words`` is 0.  A NULL id draws the noise of the empty text.
    Repeated rows are rows of their own: the noise is their id's, so they score
    alike.  An empty target leaves gains that only follow the documents; an
    empty ``docs`` gives no rows.
    """
    spark = docs.sparkSession
    names = carry or [id_col]
    row = F.struct(*[F.col(f"`{c}`") for c in names], F.col(f"`{id_col}`").alias("__key"))
    found = stored(features(docs, row, text_col, runs, buckets), "resample-features")
    aimed = features(target, F.struct(F.lit(0).alias("none")), target_text, runs, buckets)
    by_bucket = gains(histogram(found, buckets), histogram(aimed, buckets), buckets).collect()      # ``buckets`` rows
    gain = np.zeros(buckets, np.int64)
    for r in by_bucket:
        gain[r.bucket] = r.gain
    scored = stored(_weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("row.__key"), seed)), "resample-scores")

    fit = F.col("n_words") >= min_words
    drawn = percent * scored.filter(fit).count() // 100
    ranked = global_rank(scored.filter(fit), [F.col("score").desc(), F.col("row.__key").asc_nulls_last(), F.col("weight"), F.col("n_features")])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = ranked.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
    new = ["n_words", "n_features", "weight", "score", "rank"]
    kept = [F.col(f"row.`{c}`").alias(c) for c in names if c.lower() not in new]
    return out.select(*kept, *new)


ORACLE_SQL = r"""
WITH steps AS (SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i) ORDER BY i) AS t
               FROM range(256) AS r(i)),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(w) AS f FROM d
       UNION ALL SELECT r, w[p] || ' ' || w[p + 1] FROM d, unnest(range(1, len(w))) AS u(p)),
bf AS (SELECT unnest(w) AS f FROM b
       UNION ALL SELECT w[p] || ' ' || w[p + 1] FROM b, unnest(range(1, len(w))) AS u(p)),
df2 AS (SELECT r, f, count(*) AS n FROM df GROUP BY r, f), bf2 AS (SELECT f, count(*) AS n FROM bf GROUP BY f),
crc AS (SELECT f, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::BIGINT),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT f FROM df2 UNION SELECT f FROM bf2) AS a, steps),
s AS (SELECT bucket, sum(n) AS s FROM df2 JOIN crc USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bf2 JOIN crc USING (f) GROUP BY bucket),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s_all, (SELECT coalesce(sum(t), 0) FROM t) AS t_all),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
         FROM s LEFT JOIN t USING (bucket), tot),
w AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS total FROM df2 JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
                  floor(coalesce(total, 0)::DOUBLE / greatest(1, coalesce(n_features, 0)))::BIGINT AS weight,
                  ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT AS h
           FROM d LEFT JOIN w USING (r)),
full_ AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                  (SELECT 25 * count(*) // 100 FROM full_ WHERE n_words >= 20) AS drawn FROM full_)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""
