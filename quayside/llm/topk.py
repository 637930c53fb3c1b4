"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Components become integers floor(scale * x).  The vectors are dealt into blocks
of about ``BLOCK`` rows; each block's index holds, for every dimension and
quantised component value, the posting segment of the rows with that value.

For a query the segments are processed by descending impact, the most their
product with the query can add over the least that dimension can give.  Rows
accumulate certain gains, so after each round a row can reach its gain plus the
slack of quantisation plus what the unprocessed dimensions can still add.  The
k rows that can reach most are scored exactly; a row that cannot reach the least
of these scores is proven out.  Processing stops when few rows are left in; all
of them are rescored exactly.  Nothing is stopped without
that proof, and a round too many only costs time.

Every query block meets every index block once, as one row of a product that
copies neither of the two stored tables; a block pair returns k rows per query.
Nothing is collected to the driver.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import on_workers, stored

BLOCK = 4_096
QUERY_BLOCK = 1_024
LEVELS = 32         # quantised values on either side of 0
ROUNDS = (0.4, 0.5, 0.6, 0.7, 0.85, 1.0)     # parts of the postings after which to look for a proof
STOP = 2            # rescore once at most 1 / STOP of a block's rows can be members
_BIG = 2.0 ** 31    # beyond it components and sums are held as Python integers


def _integers(vectors: list, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), exactly, whatever their size; shorter vectors are
    filled with 0."""
    d = max((len(v) for v in vectors), default=0)
    x = np.zeros((len(vectors), d))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = v
    with np.errstate(over="ignore"):
        whole = np.floor(x * scale)
    if not whole.size or np.abs(whole).max() * max(1, d) ** 0.5 < _BIG:
        return whole.astype(np.int64)
    exact = [[int(w) if abs(w) < float("inf") else Fraction(y) * Fraction(scale) // 1 for w, y in zip(ws, ys, strict=True)]
             for ws, ys in zip(whole.tolist(), x.tolist(), strict=True)]
    return np.array(exact, object).reshape(x.shape)


class Index:
    """Posting segments of one block, and its exact components.

    Segments and their impacts are kept in units of the quantisation step, as
    small numbers, whatever the size of the components: what floating-point sums
    may be off by is part of every bound.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, v: np.ndarray):
        self.ids, self.row, self.v = ids, rows, v
        n, d = v.shape
        if not v.size:
            return
        most = max(abs(int(v.max())), abs(int(v.min())))
        self.step = max(1, -(-most // LEVELS))
        u = (v // self.step).astype(np.int64) + (LEVELS + 1)
        keys = (np.arange(d) * (2 * LEVELS + 2) + u).T.ravel()
        order = np.argsort(keys, kind="stable")
        self.post = (order % n).astype(np.int32)
        seen, start = np.unique(keys[order], return_index=True)
        self.start = np.append(start, len(order))
        self.dim, level = np.divmod(seen, 2 * LEVELS + 2)
        self.low = (level - (LEVELS + 1)).astype(float)
        self.one = 2.0 ** math.ceil(math.log2((2 * LEVELS + 3) * d + 1))     # above all gains of a row
        self.off = 4.0 * d * d * self.one * 2.0 ** -52                       # what sums may be off by

    def members(self, q: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Rows that can be among the k best for q; ``own`` rows never are."""
        n, d = self.v.shape
        unit = max(1, max(abs(int(q.max(initial=0))), abs(int(q.min(initial=0)))))
        w = (q / unit).astype(float)
        one, other = w[self.dim] * self.low, w[self.dim] * (self.low + 1.0)
        least, most = np.minimum(one, other), np.maximum(one, other)
        base = np.full(d, np.inf)
        np.minimum.at(base, self.dim, least)
        gain, impact = least - base[self.dim], most - base[self.dim]
        peak = np.zeros(d)
        np.maximum.at(peak, self.dim, impact)
        slack = float(np.abs(w).sum()) + self.off
        order = np.argsort(-impact, kind="stable")
        size = np.diff(self.start)
        upto = np.cumsum(size[order])
        total = np.zeros(n)
        done = np.zeros(n)
        # a posting adds its gain and, far above all gains, one processed dimension
        worth = gain + self.one
        scale, floor = unit * self.step, float(base.sum())
        lo = 0
        for part in ROUNDS:
            hi = int(np.searchsorted(upto, upto[-1] * part, side="right")) if part < 1 else len(order)
            seg = order[lo:hi]
            lo = max(lo, hi)
            if len(seg):
                ln = size[seg]
                at = np.arange(ln.sum()) + np.repeat(self.start[seg] - (np.cumsum(ln) - ln), ln)
                added = np.bincount(self.post[at], np.repeat(worth[seg], ln), n)
                dims = np.floor(added / self.one)
                done += dims
                total += added - dims * self.one
            ahead = impact[order[lo]] if lo < len(order) else 0.0
            # what a row's unprocessed dimensions can add: each at most min(ahead, its own most),
            # and a dimension is processed for a row only where its most is not below ahead
            most_left = np.minimum(ahead, peak).sum() - ahead * done
            reach = total + slack + most_left
            reach[own] = -np.inf
            # the k-th best exact score of the rows ahead so far: no row below it is among the best
            tried = np.argpartition(-reach, k)[:k]
            bar = int(_scores(self.v[tried], q).min()) / scale - floor - self.off
            left = np.flatnonzero(reach >= bar)
            if len(left) <= n // STOP:
                break
        return left

    def search(self, q: np.ndarray, query_row: int, k: int) -> list[tuple[int, int]]:
        own = np.flatnonzero(self.row == query_row)
        d = self.v.shape[1]
        q = q[:d] if len(q) >= d else np.append(q, np.zeros(d - len(q), q.dtype))
        if d and len(self.ids) - len(own) > k:
            rows = self.members(q, k, own)
        else:
            rows = np.setdiff1d(np.arange(len(self.ids)), own)
        score = _scores(self.v[rows], q)
        if score.dtype == object:
            best = sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]], self.row[rows[i]]))[:k]
        else:
            best = np.lexsort((self.row[rows], self.ids[rows], -score))[:k]
        return [(int(score[i]), int(self.ids[rows[i]]), int(self.row[rows[i]])) for i in best]


def _scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    if not len(q):
        return np.zeros(len(v), np.int64)
    return v.astype(object) @ q.astype(object) if object in (v.dtype, q.dtype) else v @ q


def _held(score: int) -> tuple[int, str]:
    """A score held at the ends of BIGINT, and a text that sorts as the part beyond:
    scores that are held alike still rank by their whole size."""
    if -2 ** 63 <= score < 2 ** 63:
        return score, "m"
    digits = f"{abs(score):x}"
    if score > 0:
        return 2 ** 63 - 1, f"p{len(digits):06d}{digits}"
    return -2 ** 63, f"a{999_999 - len(digits):06d}" + digits.translate(_COMPLEMENT)


_COMPLEMENT = str.maketrans("0123456789abcdef", "fedcba9876543210")


def _index(scale: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "row"])
        made = Index(pdf["vec_id"].to_numpy(np.int64), pdf["row"].to_numpy(np.int64), _integers(list(pdf["v"]), scale))
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "held": [pickle.dumps(made)]})
    return run


def _queries(scale: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        held = pickle.dumps((pdf["vec_id"].to_numpy(np.int64), pdf["row"].to_numpy(np.int64), _integers(list(pdf["v"]), scale)))
        return pd.DataFrame({"qblock": [pdf["qblock"].iloc[0]], "asked": [held]})
    return run


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for held, asked in zip(b["held"], b["asked"], strict=True):
                index, (ids, queries, vectors) = pickle.loads(held), pickle.loads(asked)
                rows = [(int(r), int(i), v, at, *_held(s)) for i, r, q in zip(ids, queries, vectors, strict=True) for s, v, at in index.search(q, r, k)]
                yield pd.DataFrame(rows, columns=["query_row", "query_id", "vec_id", "row", "score", "beyond"])
    return run


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(row, vec_id, v)``, every row of its own: rows with a NULL id, a NULL
    vector or a NULL or non-finite component take no part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine)
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"))


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by
    ``every`` the k highest integer inner products with all other rows.

    Ties go to the smaller vec_id.  Rows that share an id are rows of their own:
    each is a candidate for the other, and each asks if its id does, with ranks
    from 1.  A query with fewer than k other rows gets all of them; an empty
    table gives no rows.  Missing components of shorter vectors count as 0;
    components are whole numbers of any size; scores beyond BIGINT rank by their
    whole size and are returned as its ends.
    """
    on_workers(vectors.sparkSession)
    rows = stored(valid_vectors(vectors, id_col, vector_col), "topk-vectors")       # stored, so a row keeps its number
    n, m = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    blocks, qblocks = max(1, -(-n // block)), max(1, -(-m // query_block))
    index = stored(rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
                   .groupBy("block").applyInPandas(_index(scale), "block int, held binary"), "topk-index")
    asked = stored(rows.filter(F.col("vec_id") % every == 0)
                   .withColumn("qblock", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(qblocks)).cast("int"))
                   .groupBy("qblock").applyInPandas(_queries(scale), "qblock int, asked binary"), "topk-queries")
    # the blocks meet in a product of the two stored tables: neither side is repeated by hand, so what may be
    # broadcast (the queries, while their table is under Spark's threshold) is one copy, not one for each block
    pairs = index.repartition(max(1, min(blocks, 10_000)), "block").crossJoin(asked)
    found = pairs.mapInPandas(_search(k), "query_row long, query_id long, vec_id long, row long, score long, beyond string")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("beyond").desc(), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
