"""Near-duplicates by a signature-coordinate inverted join.

1. Each text becomes its set of word shingles; equal sets are one node, so a
   group of copies costs one row from here on.  A node has a MinHash signature
   of K coordinates.
2. Inverted join.  A node is posted under (coordinate, value) pairs.  Sets of
   similarity 0.8 agree on at least MATCH of K coordinates (all but about one
   pair in 10^4 at the very threshold, far fewer above), and two nodes that
   agree on MATCH coordinates meet in any K - MATCH + 1 of them taken in one
   global order.  So only this prefix is posted (prefix merging), rare values
   first: what many documents share is skipped and only looked up in the
   signatures of nodes that met elsewhere (skip merging).  Collisions are
   counted inside a posting list, and of the pairs above the threshold only
   spanning links leave the task, at most one fewer than the list has nodes.
3. The candidate clusters are confirmed on the full shingle sets of the whole
   texts, again inside tasks that return spanning links only.
4. Connected components of the confirmed links.

Lists and clusters are cut into blocks of bounded rows and bytes.  In a cut
group, every block first gets the group's pivot (its most central node); what
is then not connected to the group's largest part is compared with every block.
So no link is lost, and a group in which most nodes resemble the pivot costs
its size, not the square of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import BROADCAST_ROWS, on_workers, set_aside, stored
from quayside.llm.components import connected_components
from quayside.llm.shingles import WordHash, mix64, shingle_set

K = 64              # coordinates of a signature
MATCH = 38          # agreeing coordinates that make a candidate: 0.8 * K less 4.1 standard deviations
PREFIX = K - MATCH + 1
SAMPLE = 20_000     # nodes sampled (by hash) to learn which posting values are common
COMMON = 8          # common: held by this many sampled nodes; so at most K * SAMPLE / COMMON values are
BLOCK = 4_000       # nodes of a block
BLOCK_BYTES = 24 << 20
CACHED = 16_384     # hashes worked on at a time
SIGNED_AT_ONCE = 256    # texts whose shingle sets are held at a time

_A = mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_B = mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_COORD = (np.arange(K, dtype=np.uint64) << np.uint64(32))


def _signatures(sets: list[np.ndarray]) -> list[bytes]:
    """For each non-empty set its size (32 bits) and K minima of multiply-add
    hashes, 32 bits each."""
    out, i = [], 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= CACHED):
            total += len(sets[j])
            j += 1
        flat = np.concatenate(sets[i:j])
        sizes = np.array([len(x) for x in sets[i:j]])
        starts = np.cumsum(sizes) - sizes
        sig = np.empty((j - i, K + 1), np.uint32)
        sig[:, 0] = sizes
        for k in range(K):
            sig[:, k + 1] = np.minimum.reduceat((flat * _A[k] + _B[k]) >> np.uint64(32), starts)
        out += [row.tobytes() for row in sig]
        i = j
    return out


def _sign(width: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for batch in batches:
            for i in range(0, len(batch), SIGNED_AT_ONCE):
                b = batch.iloc[i:i + SIGNED_AT_ONCE]
                sets = [shingle_set(text, width, memo) for text in b["text"]]
                sigs = iter(_signatures([s for s in sets if len(s)]))
                yield pd.DataFrame({
                    "doc_id": list(b["doc_id"]), "th": list(b["th"]), "n": [len(s) for s in sets],
                    "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "sig": [next(sigs) if len(s) else None for s in sets]})
    return run


def _keys(sig: pd.Series) -> np.ndarray:
    values = np.frombuffer(b"".join(sig), np.uint32).reshape(len(sig), K + 1)
    return values[:, 1:].astype(np.uint64) | _COORD


def _prefix(common: np.ndarray, counts: np.ndarray) -> Callable:
    """Posting keys of a node: the PREFIX first ones in the order (common
    values last, by their count; then a hash), and how central the node is."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            keys = _keys(b["sig"])
            freq = np.zeros(keys.shape, np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
                freq = np.where(common[at] == keys, counts[at], 0)
            order = np.lexsort((mix64(keys), freq), axis=1)[:, :PREFIX]
            yield pd.DataFrame({
                "id": b["node"], "weight": freq.sum(axis=1),
                "keys": list(np.take_along_axis(keys, order, 1).astype(np.int64))})
    return run


# ---- spanning links inside a block -------------------------------------------------

def _spanning(items: list[np.ndarray], sizes: np.ndarray, enough: Callable, first: int) -> list[tuple[int, int]]:
    """Links that connect what pairs with ``enough(overlap, size, sizes)`` connect.

    One pass over an inverted list of items counts a row's overlap with every
    other row.  Row ``first`` goes first; afterwards only rows outside the
    largest part are counted, since every link between parts ends in one.
    """
    n = len(items)
    flat = np.concatenate(items)
    _, inv = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), [len(x) for x in items])
    order = np.argsort(inv, kind="stable")
    posting, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(inv))])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in items])])
    part = np.arange(n)
    out = []
    done = np.zeros(n, bool)

    def count(i: int) -> None:
        done[i] = True
        mine = inv[ends[i]:ends[i + 1]]
        lo, ln = starts[mine], starts[mine + 1] - starts[mine]
        total = ln.sum()
        at = np.arange(total) - np.repeat(np.cumsum(ln) - ln, ln) + np.repeat(lo, ln)
        overlap = np.bincount(posting[at], minlength=n)
        for j in np.flatnonzero(enough(overlap, sizes[i], sizes)):
            if part[i] != part[j]:
                part[part == part[j]] = part[i]
                out.append((i, int(j)))

    count(first)
    while True:
        sizes_of = np.bincount(part, minlength=n)
        todo = np.flatnonzero((part != sizes_of.argmax()) & ~done)
        if not len(todo):
            return out
        # the largest part can only have grown: rows left of it are counted, rows done stay done
        for i in todo[:64]:
            count(int(i))


def _similar(percent: int) -> Callable:
    return lambda o, s, sizes: 100 * o >= percent * (s + sizes - o)


def _named(ids: list, links: list[tuple[int, int]]) -> list[tuple]:
    return [(ids[i], ids[j]) for i, j in links]


def _candidates(percent: int) -> Callable:
    """Links of posting lists: at least MATCH equal coordinates, sizes that allow the similarity."""
    def run(batches):
        for b in batches:
            out = []
            for ids, data, weights in zip(b["ids"], b["data"], b["weights"], strict=True):
                raw = np.frombuffer(b"".join(data), np.uint32).reshape(len(ids), K + 1)
                n = raw[:, 0].astype(np.int64)
                if len(ids) <= 24:
                    i, j = np.triu_indices(len(ids), 1)
                    ok = (raw[i, 1:] == raw[j, 1:]).sum(axis=1) >= MATCH
                    ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
                    out += [(ids[x], ids[y]) for x, y in zip(i[ok], j[ok], strict=True)]
                    continue
                keys = raw[:, 1:].astype(np.uint64) | _COORD
                links = _spanning(list(keys), n, lambda o, s, m: (o >= MATCH) & (
                    100 * np.minimum(s, m) >= percent * np.maximum(s, m)), int(np.argmax(weights)))
                out += _named(ids, links)
            yield pd.DataFrame(out, columns=["a", "b"])
    return run


def _confirmed(width: int, percent: int) -> Callable:
    """Links of clusters on the full shingle sets."""
    def run(batches):
        memo = WordHash()
        for b in batches:
            out = []
            for ids, data, weights in zip(b["ids"], b["data"], b["weights"], strict=True):
                sets = [shingle_set(t.decode(), width, memo) for t in data]
                links = _spanning(sets, np.array([len(s) for s in sets]), _similar(percent), int(np.argmax(weights)))
                out += _named(ids, links)
            yield pd.DataFrame(out, columns=["a", "b"])
    return run


_LINK = "a binary, b binary"


def _lists(rows: DataFrame, *keys: str) -> DataFrame:
    one = F.struct("weight", "id", "data")
    return rows.groupBy(*keys).agg(F.array_distinct(F.collect_list(one)).alias("m")).filter(F.size("m") > 1).select(
        F.col("m.id").alias("ids"), F.col("m.data").alias("data"), F.col("m.weight").alias("weights"))


def spanning_links(rows: DataFrame, kernel: Callable, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``rows(g, id, weight, data)`` -> links ``(a, b)`` that connect, in every
    group g, what the kernel's pair test connects."""
    rows = stored(rows, "dedup-groups")
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.sum(F.length("data")).alias("bytes"),
                                   F.max(F.struct("weight", F.col("id"))).alias("top")).filter("c > 1")
    blocks = F.greatest(F.ceil(F.col("c") / block), F.ceil(F.col("bytes") / block_bytes)).cast("int")
    groups = stored(groups.select("g", blocks.alias("q"), F.col("top.id").alias("pivot")), "dedup-blocks")
    cut = rows.join(groups, "g").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("q")).cast("int"))
    # a pivot goes to every block of its group
    everywhere = F.when(F.col("id") == F.col("pivot"), F.sequence(F.lit(0), F.col("q") - 1)).otherwise(F.array("chunk"))
    first = _lists(cut.withColumn("chunk", F.explode(everywhere)), "g", "chunk").mapInPandas(kernel, _LINK).distinct()
    if not groups.filter("q > 1").limit(1).count():
        return first
    first = stored(first, "dedup-links")
    parts = connected_components(first).withColumnRenamed("node", "id")
    big = stored(cut.filter("q > 1").join(parts, "id", "left").withColumn("label", F.coalesce("label", "id")), "dedup-cut")
    sizes = big.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("g").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("all")).select(
        "g", F.col("m.label").alias("main"), F.ceil((F.col("all") - F.col("m.c")) / block).cast("int").alias("p"))
    big = big.join(main.filter("p > 0"), "g")
    outside = big.filter("label <> main").withColumn("o", F.pmod(F.xxhash64("id", F.lit(1)), F.col("p")).cast("int"))
    left = outside.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("q") - 1)))
    right = big.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
    cols = ["g", "o", "chunk", "id", "weight", "data"]
    second = _lists(left.select(cols).unionByName(right.select(cols)), "g", "o", "chunk").mapInPandas(kernel, _LINK)
    return first.unionByName(second.distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                    percent: int = 80, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, n_shingles, component_id, kept, chosen.

    * Linked: 100 * intersection >= percent * union of the shingle sets.
    * A NULL text or one without words has no shingles and is linked with
      nothing; its component_id is its own id.
    * component_id is the smallest id reachable (NULL ids are passed over; NULL
      if the whole component has none); kept = doc_id is component_id, and true
      where component_id is NULL.  Rows that repeat an id and a text are the
      same document and are kept or dropped alike.
    * chosen: the row has the one id and text that stand for its component (the
      smallest id, then the smallest hash of its text), or no shingles.
    * An empty table gives no rows.  Only the two named columns are read.
    """
    on_workers(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("th"))
    # ids pass through pandas as text: a column of integers with NULLs would turn into floats there
    signed = stored(texts.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _sign(width), "doc_id string, th long, n long, node binary, sig binary")
        .withColumn("doc_id", F.col("doc_id").cast("long")), "dedup-signatures")
    nodes = stored(signed.filter("node is not null").groupBy("node").agg(
        F.first("sig").alias("sig"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("low"))
        .select("node", "sig", F.col("low.doc_id").alias("low"), F.col("low.th").alias("th")), "dedup-nodes")

    # which posting values are common, from a bounded sample: any one order is exact, a good one is fast
    rate = min(1.0, SAMPLE / max(1, nodes.count()))
    sample = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int((1 << 20) * rate))

    def keys_of(batches):
        for b in batches:
            if len(b):
                yield pd.DataFrame({"key": _keys(b["sig"]).astype(np.int64).ravel()})

    common = (sample.select("sig").mapInPandas(keys_of, "key long").groupBy("key")
              .agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= COMMON).collect())   # at most K * SAMPLE / COMMON
    common.sort(key=lambda r: r.key)
    posted = nodes.select("node", "sig").mapInPandas(
        _prefix(np.array([r.key for r in common], np.uint64), np.array([r.c for r in common], np.int64)),
        "id binary, weight long, keys array<long>")
    postings = stored(posted.select("id", "weight", F.explode("keys").alias("g")), "dedup-postings")
    # stored, so that AQE can split a long list's rows in the join
    met = stored(postings.groupBy("g").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("g"), "dedup-met")
    lists = (postings.join(met, "g").join(nodes.select(F.col("node").alias("id"), F.col("sig").alias("data")), "id")
             .select("g", "id", "weight", "data"))
    clusters = stored(connected_components(spanning_links(lists, _candidates(percent), block)), "dedup-clusters")

    # the whole text of one document for each node of a cluster
    weights = postings.groupBy("id").agg(F.max("weight").alias("weight"))
    wanted = stored(clusters.select(F.col("node").alias("id"), F.col("label").alias("g")).join(weights, "id")
                    .join(nodes.select(F.col("node").alias("id"), "low", "th"), "id"), "dedup-wanted")
    small = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    full = (texts.alias("t").join(small.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.low")) & (F.col("t.th") == F.col("w.th")))
            .select("g", "id", "weight", F.col("text").cast("binary").alias("data")))
    linked = connected_components(spanning_links(full, _confirmed(width, percent), block))

    part = stored(nodes.select("node", "low", "th").join(linked, "node", "left").select(
        "node", "low", "th", F.coalesce("label", "node").alias("label")), "dedup-parts")
    lowest = part.groupBy("label").agg(F.min(F.struct(F.col("low").isNull(), "low", "th")).alias("least"))
    named = part.join(lowest, "label").select("node", F.col("least.low").alias("component_id"), F.col("least.th").alias("first"))
    out = signed.select("doc_id", "th", "n", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    chosen = F.col("node").isNull() | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("first")))
    return out.select("doc_id", F.col("th").alias("text_hash"), F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"), chosen.alias("chosen"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each component, its first by id and text.

    Rows without an id and rows that repeat an id and a text are copies like any
    others: one of them stays (the one whose columns hash highest).  Rows without
    shingles (NULL, empty and blank texts) are linked with nothing and all stay.
    """
    found = near_duplicates(docs, id_col, text_col, **how).select("doc_id", "text_hash", "n_shingles", "chosen")
    same = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("c"), F.max((F.col("n_shingles") > 0) & F.col("chosen")).alias("one"), F.min("chosen").alias("stays"))
    keys = stored(same.filter(~F.col("stays") | (F.col("one") & (F.col("c") > 1)))
                  .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"), "stays"), "dedup-dropped")
    docs, now, back = set_aside(docs, "__id", "__th", "stays")
    at = (F.col(now[id_col]).cast("long").eqNullSafe(F.col("__id"))) & (F.xxhash64(F.col(now[text_col])) == F.col("__th"))

    def side(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows

    rest = docs.join(side(keys.select("__id", "__th")), at, "left_anti")
    repeated = keys.filter("stays")
    if not repeated.limit(1).count():
        return back(rest)
    copies = docs.join(side(repeated.select("__id", "__th")), at)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = copies.groupBy("__id", "__th").agg(F.max_by(whole, F.xxhash64(F.to_json(whole))).alias("row"))
    return back(rest.unionByName(one.select("row.*")))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 4) - 1], ' ') AS g
       FROM d, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS u(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(doc_id, low) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT e.b, r.low FROM reach r JOIN e ON e.a = r.doc_id WHERE r.low < e.b),
c AS (SELECT doc_id, min(low) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
