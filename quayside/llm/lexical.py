"""Exact ranked lexical search with MaxScore over term-pair bounds.

A document's impact for a term is an integer, and its score is the sum over a
query's terms.  The documents lie in blocks; the index of a block holds, for
every term, its postings with their impacts and the highest of these.  For
pairs of terms it also has what their intersection list gives: how many documents
hold both, and the highest joint impact among them.  Two terms that never meet in
a block can't both add to a document, however high each can be alone.

A query's terms are bound together in pairs, and a pair can add at most what
its intersection list or one of its terms alone can.  Terms are processed by
falling bound.  Once the k-th best score so far is above all that the rest can
add, no new document is taken up; the rest then only completes documents that
can still reach that score.  Pair bounds make the rest's sum smaller than the
sum of the terms' own maxima, so that point comes earlier.  Only proof ends
anything: scores are exact integers, ties go to the smaller id.

Blocks are formed where their documents lie, without a shuffle.  A task keeps
the best k of each query over all its blocks, so it sends at most k rows a
query, and the k-th of them is the bar that its next block has to pass.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import on_workers, stored

_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
BLOCK = 4_096
TOP = 20
MAX_TERMS = 50_000      # different query terms of one pass over the documents
MAX_QUERIES = 2_000     # queries of one pass
NULL_ID = 2 ** 63 - 1   # stands for a NULL id inside tasks, after all others
#: Fixed values of the score: 1000 * tf / (tf + 1.2 * m / 100), in integers.
SCALE, TF, LENGTH, FLAT, SLOPE = 1_000_000_000, 1_000, 12, 75, 25


def terms(text: str | None) -> list[str]:
    """Terms of a text, only A-Z lower-cased."""
    return _TERMS(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else []


class Query(NamedTuple):
    number: int
    item_id: int | None
    terms: list[tuple[int, int]]        # (term, times)


def forward(docs: DataFrame, vocabulary: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms counted in ``n``, those of the
    ``vocabulary`` by number.  Texts without terms give no row; a NULL id is NULL_ID."""
    handle = docs.sparkSession.sparkContext.broadcast(vocabulary)        # at most MAX_TERMS words, or one query's

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = handle.value
        for b in batches:
            rows = []
            for text, doc in zip(b["text"], b["doc_id"], strict=True):
                found = Counter(terms(text))
                if found:
                    held = [(number[t], c) for t, c in found.items() if t in number]
                    rows.append((doc, found.total(), [t for t, _ in held], [c for _, c in held]))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "tfs"])

    some = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return some.mapInPandas(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Block:
    """Postings, impacts and pair lists of one block."""

    def __init__(self, docs: np.ndarray, of_term: dict[int, tuple[np.ndarray, np.ndarray]], pairs: set[tuple[int, int]]):
        self.docs = docs                 # ids, ascending
        self.post = of_term
        self.high = {t: int(v.max()) for t, (_, v) in of_term.items()}
        by_first: dict[int, list[int]] = {}
        for a, b in pairs:
            by_first.setdefault(a, []).append(b)
        # of each pair's intersection list: its length and its highest joint impact
        self.joint: dict[tuple[int, int], tuple[int, int]] = {}
        mark = np.zeros(len(docs), np.int64)
        for a in {a for a, _ in pairs} & of_term.keys():
            rows, impact = of_term[a]
            mark[rows] = impact + 1
            for b in by_first[a]:
                if b in of_term:
                    other, more = of_term[b]
                    met = mark[other] > 0
                    self.joint[a, b] = int(met.sum()), int((mark[other] - 1 + more)[met].max(initial=0))
            mark[rows] = 0

    def bound(self, one: tuple[int, int], two: tuple[int, int] | None) -> int:
        """The most that one term, or two together, add to a document."""
        (a, m), u = one, self.high.get(one[0], 0)
        if two is None:
            return m * u
        (b, n), v = two, self.high.get(two[0], 0)
        both = self.joint.get((a, b))
        if both is None:                 # one of them isn't in the block
            return m * u + n * v
        least = min(m, n)                # m x + n y = least (x + y) + the rest
        length, high = both
        met = least * high + (m - least) * u + (n - least) * v if length else 0
        return max(m * u, n * v, min(met, m * u + n * v))

    def search(self, groups: list, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the block that may be among the k best, with their exact scores.
        Rows below ``bar``, the k-th best score found elsewhere, may be left out."""
        bounds = [self.bound(*g) for g in groups]
        order = sorted(range(len(groups)), key=lambda i: -bounds[i])
        after = np.append(np.cumsum([bounds[i] for i in reversed(order)])[::-1], 0) if order else np.zeros(1, np.int64)
        total = np.zeros(len(self.docs), np.int64)
        live = None                      # rows that can still reach the bar; None: any row
        for step, g in enumerate(order):
            rest = int(after[step])
            if rest == 0:
                break
            if live is None and bar > rest:
                live = np.flatnonzero(total + rest >= bar)
            elif live is not None:
                live = live[total[live] + rest >= bar]
            if live is not None and not len(live):
                break
            for term, times in (t for t in groups[g] if t is not None):
                rows, impact = self.post.get(term, (None, None))
                if rows is None:
                    continue
                if live is None or len(live) * 8 > len(rows):
                    total[rows] += times * impact
                else:                    # look up the few rows that are left
                    at = np.minimum(np.searchsorted(rows, live), len(rows) - 1)
                    hit = rows[at] == live
                    total[live[hit]] += times * impact[at[hit]]
            if len(total) >= k:          # scores only grow: the k-th best so far is a bar
                bar = max(bar, int(np.partition(total, len(total) - k)[len(total) - k]))
        rows = np.flatnonzero(total > 0) if live is None else live[total[live] > 0]
        score = total[rows]
        if len(rows) > k:
            last = np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[score >= last], score[score >= last]
            best = np.lexsort((self.docs[rows], -score))[:k]
            rows, score = rows[best], score[best]
        return rows, score


def paired(query: Query, weight: dict[int, int]) -> list[tuple]:
    """A query's terms two by two, by falling weight: rare with rare, frequent with frequent."""
    order = sorted(query.terms, key=lambda t: (-weight[t[0]], t[0]))
    pairs = [tuple(sorted(order[i:i + 2])) for i in range(0, len(order) - 1, 2)]
    return pairs + [(t, None) for t in order[len(order) & ~1:]]


def _blocks(weight: dict[int, int], n_docs: int, n_terms: int, pairs: set[tuple[int, int]], size: int):
    def made(rows: list[pd.DataFrame]) -> bytes:
        pdf = pd.concat(rows).sort_values("doc_id", kind="stable")
        n = pdf["n"].to_numpy(np.int64)
        m = FLAT + (SLOPE * n * n_docs) // n_terms
        lengths = np.fromiter(map(len, pdf["terms"]), np.int64, len(pdf))
        row = np.repeat(np.arange(len(pdf)), lengths)
        term = np.concatenate([*pdf["terms"], np.empty(0, np.int32)]).astype(np.int64)
        tf = np.concatenate([*pdf["tfs"], np.empty(0, np.int64)]).astype(np.int64)
        w = np.array([weight[t] for t in range(len(weight))], np.int64)
        impact = w[term] * ((SCALE * tf) // (TF * tf + LENGTH * m[row]))
        order = np.lexsort((row, term))
        term, row, impact = term[order], row[order], impact[order]
        seen, start = np.unique(term, return_index=True)
        ends = np.append(start, len(term))[1:]
        post = {int(t): (row[a:b].astype(np.int32), impact[a:b]) for t, a, b in zip(seen, start, ends, strict=True)}
        return pickle.dumps(Block(pdf["doc_id"].to_numpy(np.int64), post, pairs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for b in batches:
            while len(b):
                part, b = b.iloc[:size - rows], b.iloc[size - rows:]
                held.append(part)
                rows += len(part)
                if rows == size:
                    yield pd.DataFrame({"block": [made(held)]})
                    held, rows = [], 0
        if rows:
            yield pd.DataFrame({"block": [made(held)]})
    return run


def _search(asked: list[tuple[Query, list]], k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in asked]      # scores, ids: k of each at most
        for b in batches:
            for held in b["block"]:
                block = pickle.loads(held)
                for i, (_, groups) in enumerate(asked):
                    score, ids = best[i]
                    rows, found = block.search(groups, k, int(score[-1]) if len(score) == k else 0)
                    if len(rows):
                        score, ids = np.append(score, found), np.append(ids, block.docs[rows])
                        order = np.lexsort((ids, -score))[:k]
                        best[i] = score[order], ids[order]
        for (query, _), (score, ids) in zip(asked, best, strict=True):
            if len(score):
                yield pd.DataFrame({"number": query.number, "doc_id": ids, "score": score})
    return run


def _passes(items: DataFrame, id_col: str, text_col: str, max_terms: int, max_queries: int) -> Iterator[tuple[list[Query], dict[str, int]]]:
    """The queries of each pass, and the numbers of their terms.  Rows come to the
    driver one partition after another, those of one pass at a time are held."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    queries, number, vocabulary = [], 0, {}
    for r in rows.toLocalIterator():
        found = Counter(terms(r.text))
        if queries and (len(queries) >= max_queries or len(vocabulary.keys() | found.keys()) > max_terms):
            yield queries, vocabulary
            queries, vocabulary = [], {}
        queries.append(Query(number, r.item_id, [(vocabulary.setdefault(t, len(vocabulary)), c) for t, c in sorted(found.items())]))
        number += 1
    if queries:
        yield queries, vocabulary


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           k: int = TOP, block: int = BLOCK, max_terms: int = MAX_TERMS, max_queries: int = MAX_QUERIES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item.

    Only scores above 0 count, so a term that stands in all documents of a large
    collection (weight 0) finds nothing by itself.  NULL, empty and blank texts
    hold no terms: such documents are never found and aren't counted, such items
    find nothing.  Every row of either table is one of its own: repeated ids
    are ranked as rows, each item row with ranks from 1.  Ties go to the smaller
    doc_id, NULL last (an id of 2**63 - 1 counts as NULL).  Other columns aren't looked at.

    Items are searched in passes of ``max_queries`` items and ``max_terms``
    different terms; each pass reads the documents once.
    """
    spark = on_workers(docs.sparkSession)
    found = None
    for queries, vocabulary in _passes(items, item_col, item_text, max_terms, max_queries):
        rows = stored(forward(docs, vocabulary, id_col, text_col), "lexical-forward")
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r.term: r.df for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}   # a row for each term of the pass
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))}
        asked = [(q, paired(q, weight)) for q in queries]
        pairs = {(a[0], b[0]) for _, groups in asked for a, b in groups if b is not None}
        index = stored(rows.mapInPandas(_blocks(weight, n_docs, max(1, n_terms), pairs, block), "block binary"), "lexical-index")
        part = index.mapInPandas(_search(asked, k), "number long, doc_id long, score long")
        names = spark.createDataFrame([(q.number, q.item_id) for q in queries], "number long, item_id long")
        part = part.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID))).join(F.broadcast(names), "number")     # at most ``max_queries`` rows
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark WHERE text IS NOT NULL),
tot AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(w)::BIGINT * n_docs) // n_terms AS m FROM d, tot WHERE len(w) > 0),
post AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) AS x
         WHERE term IN (SELECT term FROM q) GROUP BY r, term),
wt AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM post, tot GROUP BY term, n_docs),
imp AS (SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS v FROM post JOIN wt USING (term) JOIN m USING (r)),
s AS (SELECT i, item_id, r, sum(v)::BIGINT AS score FROM q JOIN imp USING (term) GROUP BY i, item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
           FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
