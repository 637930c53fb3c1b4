"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items form one automaton (several, if they hold more
than ``MAX_TOKENS`` words; each then has a pass over the documents of its own, so
that no process holds two).  A document's words stream through it; the current state and
match length say which window of an item ends at each word.  Runs of words that
no item holds are stepped over at once, since no window can touch them.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import set_aside, stored

WINDOW = 10
#: Words of the items that one automaton holds: what is collected to the driver
#: and broadcast at a time (about 0.5 KB a word).
MAX_TOKENS = 100_000
#: Limits at which ``clean`` cuts a span or drops a document.
MAX_SPAN_WORDS = 10
MAX_COVERAGE = 0.5

#: Bytes of words: digits, lower-case letters (A-Z become these) and all of 0x80 up.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) else 32
               for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Automaton:
    """Generalised suffix automaton over word ids.

    For each state: ``step`` (word -> state), ``link`` and ``length`` (its
    longest string).  ``hits`` gives, per state, the windows that are suffixes
    of a match ending there: (window length, least match length, item numbers).
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.word: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.shortest = window
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.word.setdefault(w, len(self.word)))
        members = [set() for _ in self.step]
        whole: list[dict[int, set[int]]] = [{} for _ in self.step]    # short items ending at a state, by length
        for name, words in items:
            i, state = number[name], 0
            for w in words:
                state = self.step[state][self.word[w]]
                members[state].add(i)
            if 0 < len(words) < window:
                whole[state].setdefault(len(words), set()).add(i)
                self.shortest = min(self.shortest, len(words))
        by_length = sorted(range(1, len(self.step)), key=self.length.__getitem__)
        for v in reversed(by_length):                                  # items of a state are those of its suffixes' states too
            members[self.link[v]] |= members[v]
        self.hits: list[tuple] = [()] * len(self.step)
        for v in by_length:
            own = [(n, n, tuple(s)) for n, s in whole[v].items()]
            if self.length[self.link[v]] < window <= self.length[v]:
                own.append((window, window, tuple(members[v])))
            self.hits[v] = (*own, *((n, 0, s) for n, _, s in self.hits[self.link[v]]))

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of the longest string of p followed by w, cut out of q."""
        copy = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        cur = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and w not in self.step[p]:
            self.step[p][w] = cur
            p = self.link[p]
        if p != -1:
            q = self.step[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return cur

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [start, end) that windows cover, and the items hit."""
        get = self.word.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate([[0], (ids >= 0).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(known))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if hi - lo < self.shortest:
                continue
            state = match = 0
            for at, w in enumerate(ids[lo:hi].tolist(), lo + 1):
                nxt = self.step[state].get(w)
                while nxt is None and state:
                    state = self.link[state]
                    match = self.length[state]
                    nxt = self.step[state].get(w)
                if nxt is None:
                    match = 0
                    continue
                state, match = nxt, match + 1
                for n, least, who in self.hits[state]:
                    if match >= least:
                        items.update(who)
                        if spans and spans[-1][0] <= at - n <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], at)
                        else:
                            spans.append((at - n, at))
        return spans, {self.names[i] for i in items}


def _item_groups(benchmark: DataFrame, id_col: str, text_col: str, max_tokens: int) -> tuple[DataFrame, int]:
    """``(id, text)`` of the items with text, and how many automata they need."""
    items = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    return items, max(1, -(-total // (2 * max_tokens)))      # a word takes two characters at least


def _each_automaton(items: DataFrame, groups: int, window: int) -> Iterator[Automaton]:
    """One automaton at a time; its items (about ``MAX_TOKENS`` words, one item
    is never divided) come to the driver."""
    for g in range(groups):
        mine = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(groups)) == g).distinct()
        yield Automaton(sorted((r.id, w) for r in mine.toLocalIterator() if (w := words_of(r.text))), window)


def automata(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
             window: int = WINDOW, max_tokens: int = MAX_TOKENS) -> list[Automaton]:
    """The automata of all items at once, for a benchmark known to be small."""
    return list(_each_automaton(*_item_groups(benchmark, id_col, text_col, max_tokens), window))


def _marks(texts: DataFrame, automaton: Automaton) -> DataFrame:
    """``(key, mark)`` of the distinct texts of ``texts(key, text)`` that one
    automaton hits, written; the automaton is held for this pass alone."""
    handle = texts.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hit = [(k, found) for k, t in zip(b["key"], b["text"], strict=True) if (found := handle.value.scan(words_of(t)))[0]]
            yield pd.DataFrame([(k, pickle.dumps(found)) for k, found in hit], columns=["key", "mark"])

    out = stored(texts.mapInPandas(run, "key string, mark binary").distinct(), "decontam-marks")
    handle.destroy()
    return out


def _finder(rows: DataFrame, benchmark: DataFrame, window: int, max_tokens: int) -> tuple[DataFrame, Callable]:
    """``rows(..., __text)`` with a column ``__told``, and what gives a row's
    spans and items: ``find(words, told)``.

    A benchmark of one automaton is scanned for by ``find`` itself.  One that
    needs more takes a pass over the texts for each, so that driver and tasks
    hold one automaton at a time; the marks of the texts hit come with the rows.
    """
    items, groups = _item_groups(benchmark, "item_id", "text", max_tokens)
    made = _each_automaton(items, groups, window)
    if groups == 1:
        handle = rows.sparkSession.sparkContext.broadcast(next(made))
        return rows.withColumn("__told", F.lit(None).cast("array<binary>")), lambda words, told: handle.value.scan(words)
    keyed = rows.withColumn("__key", F.sha2(F.coalesce("__text", F.lit("")).cast("binary"), 256))
    texts = keyed.select(F.col("__key").alias("key"), F.col("__text").alias("text"))
    passes = [_marks(texts, a) for a in made]
    told = reduce(DataFrame.unionByName, passes).groupBy(F.col("key").alias("__key")).agg(F.collect_list("mark").alias("__told"))
    # one row per text hit (a mark for each pass); AQE splits a text that very many rows share
    return keyed.join(stored(told, "decontam-told"), "__key", "left").drop("__key"), _read_marks


def _read_marks(words: list[bytes], told) -> tuple[list[tuple[int, int]], set[str]]:
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    for mark in () if told is None else told:
        s, i = pickle.loads(mark)
        spans += s
        items |= i
    return _merged(spans), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids, spans, text)`` of every row.

    ``spans`` are merged word spans [start, end); ``item_ids`` are sorted as
    strings.  NULL text: no words, no hits.  A NULL item_id counts as the empty
    string; items without words match nothing; repeated items count once.  An
    empty benchmark leaves every document clean.
    """
    rows, find = _finder(docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("__text")),
                         benchmark, window, max_tokens)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, told in zip(b["__text"], b["__told"], strict=True):
                words = words_of(text)
                spans, items = find(words, told)
                spans = _merged(spans)
                rows.append((len(words), sum(y - x for x, y in spans), sorted(items), [{"s": x, "e": y} for x, y in spans]))
            yield pd.DataFrame({"doc_id": b["doc_id"], **{
                c: [r[k] for r in rows] for k, c in enumerate(("n_words", "n_hit", "item_ids", "spans"))}, "text": b["__text"]})

    return rows.mapInPandas(
        run, "doc_id string, n_words long, n_hit long, item_ids array<string>, spans array<struct<s:long,e:long>>, text string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          window: int = WINDOW, max_tokens: int = MAX_TOKENS, max_span: int = MAX_SPAN_WORDS,
          max_coverage: float = MAX_COVERAGE, drop: bool = False) -> DataFrame:
    """``docs`` without benchmark passages, with the columns they came with.

    Covered spans of ``max_span`` words and more are cut from the text, together
    with the marks between their words; shorter ones (of short items) are cut
    too where spans cover ``max_coverage`` of the words or more, in which case
    the document goes altogether.  ``drop``: every document with a span goes, a
    whole short item too, since each span holds a whole window.
    """
    docs, now, back = set_aside(docs, "__text", "__told", "__key")
    text_col = now[text_col]
    kept, find = _finder(docs.withColumn("__text", F.col(text_col)), benchmark, window, max_tokens)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, keep = [], []
            for text, told in zip(b["__text"], b["__told"], strict=True):
                words = words_of(text)
                spans = _merged(find(words, told)[0])
                covered = sum(y - x for x, y in spans)
                long = [x for x in spans if x[1] - x[0] >= min(max_span, len(words))]
                full = bool(words) and covered >= max_coverage * len(words)
                keep.append(not (full or (drop and spans)))
                texts.append(_cut(text, long) if long and keep[-1] else text)
            yield b.drop(columns="__told").assign(__text=texts)[keep]

    return back(kept.mapInPandas(run, kept.drop("__told").schema).withColumn(text_col, F.col("__text")))


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], at.astype(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:starts[a]])
        last = ends[b - 1]
    out.append(raw[last:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(p) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
        FROM d, lens, unnest(range(1, len(w) - n + 2)) AS u(p) WHERE len(w) >= n),
m AS (SELECT pos.r, pos.p, pos.n, win.item FROM pos JOIN win ON pos.g = win.g AND pos.n = win.n),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM m, unnest(range(p, p + n)) AS u(q) GROUP BY r),
who AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN who USING (r)
"""
