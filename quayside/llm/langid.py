"""Language identification by word-first backoff.

A word the model knows scores its log frequency in each language.  An unseen
word is covered from left to right by the longest known character n-grams
(``MAX_GRAM`` down to 1, word ends marked), each scoring its log frequency.  The
sums over a text, whole and not a prefix, give a posterior over the languages.

The model is fitted on a bounded sample of labelled rows (about ``SAMPLE_ROWS``,
chosen by a hash of id and text) and keeps about ``MAX_WORDS`` words and
``MAX_GRAMS`` n-grams, so its size is bounded by these parameters.  Each bound is
dealt to the languages in equal shares (what one has no use for goes to the
others): a rare language has its commonest words beside a hot one's.  Every
language with letters in the sample can be predicted.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quayside.llm.common import BROADCAST_ROWS, on_workers, stored

SAMPLE_ROWS = 20_000
MAX_WORDS = 60_000
MAX_GRAMS = 40_000
MAX_GRAM = 4
SMOOTH = 0.5
UNKNOWN = "und"
MEMO_WORDS = 100_000
CHUNK = 100_000        # words scored at a time

#: A word is a run of letters (of any script).
_LETTERS = re.compile(r"[^\W\d_]+")


def _pieces(word: str) -> str:
    return f"^{word}$"


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]       # word -> row of logs
    grams: dict[str, int]
    logs: np.ndarray            # rows x languages

    def unseen(self, word: str) -> np.ndarray:
        """Sum of the log frequencies of the n-grams that cover a word."""
        marked, at = _pieces(word), 0
        total = np.zeros(len(self.langs))
        while at < len(marked):
            for n in range(min(MAX_GRAM, len(marked) - at), 0, -1):
                row = self.grams.get(marked[at:at + n])
                if row is not None:
                    total += self.logs[row]
                    break
            at += n
        return total


class _Scores(dict):
    """word -> row of a table of scores that grows as words turn up."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.table = np.empty((1024, len(model.langs)))
        self.used = 0

    def __missing__(self, word: str) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        known = self.model.words.get(word)
        self.table[self.used] = self.model.logs[known] if known is not None else self.model.unseen(word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def of(self, text: str | None) -> np.ndarray | None:
        """Summed scores of all words; None without letters."""
        total = None
        found = (m.group() for m in _LETTERS.finditer(text.lower())) if text and len(text) > 10_000_000 else (
            _LETTERS.findall(text.lower()) if text else ())
        found = iter(found)
        while part := list(islice(found, CHUNK)):
            if self.used > MEMO_WORDS:
                self.clear()
                self.used = 0
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            now = self.table[rows].sum(axis=0)
            total = now if total is None else total + now
        return total


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text mod 5 is 0; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _level(sizes: list[tuple[int, int]], total: float) -> float:
    """The share at which groups, given as (size, how many of it), take ``total`` together."""
    left, groups = float(total), sum(n for _, n in sizes)
    for size, n in sorted(sizes):
        if size * groups > left:
            return left / groups
        left -= size * n
        groups -= n
    return float(1 << 60)


def _sample(rows: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows, in equal shares of the languages."""
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-languages")
    level = _level([(r.n, r.t) for r in sizes.groupBy("n").agg(F.count(F.lit(1)).alias("t")).collect()], sample_rows)
    parts = sizes.select("lang", (F.least(F.lit(1.0), F.lit(level) / F.col("n")) * (1 << 30)).cast("long").alias("part"))
    parts = F.broadcast(parts) if sizes.count() <= BROADCAST_ROWS else parts
    return rows.join(parts, "lang").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("part")).select("text", "lang")


def _commonest(counts: DataFrame, most: int, name: str) -> tuple[list[str], np.ndarray, list[str]]:
    """About ``most`` words of ``counts(lang, word, c)``, the commonest of each
    language in equal shares (by a hash among the last equal counts), sorted; their
    counts in all languages; and the languages.

    The chosen words and counts are stored in order and come to the driver as
    columns, not as rows: a few bytes for each word and language.
    """
    classes = defaultdict(list)
    for r in counts.groupBy("lang", "c").agg(F.count(F.lit(1)).alias("t")).collect():    # a language has few different counts
        classes[r.lang].append((r.c, r.t))
    level, cuts = _level([(sum(t for _, t in x), 1) for x in classes.values()], most), []
    for lang, found in classes.items():
        left, least, part = level, 0, 0
        for c, t in sorted(found, reverse=True):
            if t > left:
                least, part = c, int((1 << 30) * left / t)
                break
            left -= t
        cuts.append((lang, least, part))
    langs = sorted(classes)
    cut = F.broadcast(counts.sparkSession.createDataFrame(cuts, "lang string, least long, part long"))   # a row for each language of the sample
    take = (F.col("c") > F.col("least")) | ((F.col("c") == F.col("least")) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.col("part")))
    chosen = counts.join(cut, "lang").filter(take).select("word").distinct()
    kept = stored(counts.join(chosen, "word").select("word", "lang", "c").orderBy("word", "lang"), name)
    table = kept.orderBy("word", "lang").toArrow()
    words, which = np.unique(table["word"].to_numpy(zero_copy_only=False).astype(object), return_inverse=True) if len(table) else ([], [])
    out = np.zeros((len(words), len(langs)), np.float64)
    if len(table):
        at = {k: i for i, k in enumerate(langs)}
        out[which, [at[x] for x in table["lang"].to_pylist()]] = table["c"].to_numpy()
    return list(words), out, langs


def _logs(counts: np.ndarray) -> np.ndarray:
    """Log frequencies by language, smoothed as if all languages had as much
    text: what a language never holds is equally unlikely in each."""
    total = counts.sum(axis=0)
    most = total.max(initial=0)
    return np.log((counts * (most / np.maximum(1, total)) + SMOOTH) / (most + SMOOTH * max(1, len(counts))))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``(doc_id, text, lang)``; rows without text or lang are passed over."""
    on_workers(labelled.sparkSession)
    some = _sample(labelled.filter("text is not null and lang is not null").select("doc_id", "text", "lang"), sample_rows)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                c = Counter(w for t in texts for w in _LETTERS.findall(t.lower()))
                yield pd.DataFrame([(lang, w, n) for w, n in c.items()], columns=["lang", "word", "c"])

    by_word = stored(some.mapInPandas(words, "lang string, word string, c long").groupBy("word", "lang").agg(F.sum("c").alias("c")), "langid-words")

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter()
            for lang, word, k in zip(b["lang"], b["word"], b["c"], strict=True):
                marked = _pieces(word)
                for n in range(1, MAX_GRAM + 1):
                    for i in range(len(marked) - n + 1):
                        c[lang, marked[i:i + n]] += k
            yield pd.DataFrame([(*x, n) for x, n in c.items()], columns=["lang", "word", "c"])

    by_gram = stored(by_word.select("lang", "word", "c").mapInPandas(grams, "lang string, word string, c long").groupBy(
        "word", "lang").agg(F.sum("c").alias("c")), "langid-grams")
    words_, word_counts, langs = _commonest(by_word, MAX_WORDS, "langid-top-words")
    grams_, gram_counts, _ = _commonest(by_gram, MAX_GRAMS, "langid-top-grams")
    length = np.fromiter(map(len, grams_), np.int64, len(grams_))
    logged = np.zeros_like(gram_counts)
    for n in range(1, MAX_GRAM + 1):   # frequencies among n-grams of the same length
        logged[length == n] = _logs(gram_counts[length == n])
    table = np.concatenate([_logs(word_counts), logged]) if langs else np.zeros((0, 0))
    return Model(langs, {w: i for i, w in enumerate(words_)}, {g: len(words_) + i for i, g in enumerate(grams_)}, table)


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "__lang", score_col: str = "__score") -> DataFrame:
    """``docs`` with ``lang_col`` and ``score_col`` (the posterior of that language);
    columns of the caller's with these names are replaced.

    A NULL text, one without letters, or a model without languages: ``und``, 0.
    Ties go to the language that sorts first.
    """
    handle = on_workers(docs.sparkSession).sparkContext.broadcast(model)
    clash = [c for c in docs.columns if c.lower() in (lang_col.lower(), score_col.lower()) and c != text_col]
    docs = docs.drop(*clash)
    if text_col.lower() in (lang_col.lower(), score_col.lower()):
        raise ValueError(f"the result column can't be called {text_col}, as the text is")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = _Scores(handle.value)
        for b in batches:
            lang, score = [], []
            for text in b[text_col]:
                s = scores.of(text) if scores.model.langs else None
                if s is None:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                else:
                    best = int(s.argmax())
                    lang.append(scores.model.langs[best])
                    score.append(float(1 / np.exp(s - s[best]).sum()))
            yield b.assign(**{lang_col: lang, score_col: score})

    out = StructType([*docs.schema.fields, StructField(lang_col, StringType()), StructField(score_col, DoubleType())])
    return docs.mapInPandas(run, out)


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``(doc_id, text, lang)``.

    The model learns from the rows that are not held out.  Prediction sees the
    text only.  Repeated rows are predicted alike.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    model = fit(docs.filter(~held_out(F.col("doc_id"))), sample_rows)
    found = predict(docs.select(F.col("doc_id").cast("string"), "text"), model).withColumn("doc_id", F.col("doc_id").cast("long"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))
