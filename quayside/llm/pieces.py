"""SentencePiece BPE encoding and decoding by a table of last tokens.

Byte-pair merging gives every prefix of a text one tokenisation, and the
tokenisations of a text's prefixes nest: cut the last token off one and what is
left is the tokenisation of a shorter prefix.  So one table entry for each
prefix, its last token, holds all of them.  An automaton over the vocabulary
names the tokens that end at a position; the one that belongs there is the only
one that merging would leave beside the last token of the prefix before it.
That is a property of the two tokens alone (merging them character by character
gives just these two), tested once for each pair.  The ids of the whole text
are then read off the table from its end.

Characters that no merge can join part a text into stretches whose tables are
independent: the model's own pieces say which (a word mark after another
character, characters that stand in no longer piece).  Short stretches recur,
so a task remembers the ids of many of them.

Merges follow the pieces' scores, higher first, then the leftmost; a character
without a piece becomes its UTF-8 bytes where the model has byte pieces, else
one unknown id for each run of such characters.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import on_workers

MARK = "▁"         # stands for a blank
WORDS = 300_000         # remembered by a task, twice over
STRETCHES = 300_000
PAIRS = 1_000_000
NONE = float("-inf")
PAIR = 1 << 32           # before * PAIR + token names a pair
SHORT = 48              # characters of a word worth remembering
UNKNOWN_TEXT = " ⁇ "      # fixed value: what the library decodes an unknown id to


class _Memo(dict):
    """What ``make`` gives for a key; forgets what wasn't asked for lately: of two
    halves the older one goes."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """Pieces, scores and kinds of a model file's bytes."""

    def __init__(self, proto: bytes):
        lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(lib.vocab_size())
        if any(lib.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        self.lib, self.eos, self.bos, self.unk = lib, lib.eos_id(), lib.bos_id(), lib.unk_id()
        special = {i for i in ids if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)}
        self.control = {i for i in ids if lib.is_control(i)}
        self.byte_of = {i: int(lib.id_to_piece(i)[1:-1], 16) for i in ids if lib.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.piece = [lib.id_to_piece(i) for i in ids]
        self.id = {self.piece[i]: i for i in ids if i not in special}
        self.score = {p: lib.get_score(i) for p, i in self.id.items()}
        self.leading = lib.encode("a", out_type=str)[0].startswith(MARK) if len(ids) else False


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, i in v.id.items():
            self.automaton.add_word(piece, (i, len(piece)))
        if v.id:
            self.automaton.make_automaton()
        self.stretches = re.compile(self.pattern([p for p in v.id if len(p) > 1])).findall
        self.whole = self.stretches("a" + MARK + "a") == ["a" + MARK + "a"]       # pieces go on after a blank
        self.made: list = [None] * len(v.piece)
        self.pairs = _Memo(self.fits, PAIRS)
        self.known = _Memo(self.stretch, STRETCHES)
        self.words = _Memo(self.word, WORDS)

    @staticmethod
    def pattern(longer: list[str]) -> str:
        """Regular expression of the stretches.  Characters are of one class if they
        stand side by side in a piece; the classes of ASCII signs that hold no
        ASCII letter, and ASCII characters in no longer piece, are told apart."""
        if any(MARK in p.lstrip(MARK) for p in longer):     # a piece goes on after a blank
            return "(?s:.+)"
        of: dict[str, set[str]] = {}
        for p in longer:
            chars = p.lstrip(MARK)
            for one, two in zip(chars, chars[1:], strict=False):
                a, b = of.setdefault(one, {one}), of.setdefault(two, {two})
                if a is not b:
                    a, b = (a, b) if len(a) >= len(b) else (b, a)
                    a |= b
                    for c in b:
                        of[c] = a
            if len(chars) == 1:         # a mark and this character
                of.setdefault(chars, {chars})
        ascii_ = [chr(i) for i in range(128)]
        signs = {c for i in ascii_ if not i.isalpha() and i in of and not any(x.isascii() and x.isalpha() for x in of[i]) for c in of[i]}
        alone = "".join(re.escape(c) for c in ascii_ if c not in of)
        sign = "".join(re.escape(c) for c in sorted(signs))
        parts = ([f"[{alone}]"] if alone else []) + ([f"{MARK}*[{sign}]+"] if sign else []) + [f"{MARK}*[^{alone}{sign}{MARK}]+", f"{MARK}+"]
        return "|".join(parts)

    def steps(self, token: int) -> tuple[list, list, list, bool]:
        """Merging a token's characters, step by step: the score of each next merge,
        the last and the first symbol before it; and whether the token comes out whole."""
        found = self.made[token]
        if found is None:
            score, symbols = self.v.score, list(self.v.piece[token])
            next_, last, first = [], [], []
            while True:
                joins = [score.get(x + y, NONE) for x, y in zip(symbols, symbols[1:], strict=False)]
                best = max(joins, default=NONE)
                next_.append(best)
                last.append(symbols[-1])
                first.append(symbols[0])
                if best == NONE:
                    break
                at = joins.index(best)          # the leftmost of equal scores
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            found = self.made[token] = next_, last, first, len(symbols) == 1
        return found

    def fits(self, pair: int) -> bool:
        """Whether merging leaves a token whole beside the one before it (-1: at the
        start of a stretch): no merge of their touching symbols ever comes first."""
        before, token = divmod(pair, PAIR)
        right, _, first, whole = self.steps(token)
        if before < 0 or not whole:
            return whole
        left, last, _, _ = self.steps(before)
        score, i, j = self.v.score, 0, 0
        while True:
            across, a, b = score.get(last[i] + first[j], NONE), left[i], right[j]
            if across > a and across >= b:      # of equal scores the leftmost
                return False
            if a >= b:
                if a == NONE:
                    return True
                i += 1
            else:
                j += 1

    def table(self, s: str) -> list[int]:
        """For every prefix the id of its last token; -1 where that is a character without a piece."""
        last = [-1] * (len(s) + 1)
        done, known, pairs = -1, self.pairs.get, self.pairs
        for end, (token, length) in self.automaton.iter(s) if self.v.id else ():
            if end != done:
                # before a character without a piece nothing merges across, as at the start (-1)
                pair = last[end + 1 - length] * PAIR + token
                fit = known(pair)
                if pairs[pair] if fit is None else fit:
                    last[end + 1], done = token, end
        return last

    def stretch(self, s: str) -> bytes:
        """Ids of a stretch (as int32 bytes), read off its table from the end."""
        last, piece = self.table(s), self.v.piece
        out, at = [], len(s)
        while at:
            token = last[at]
            if token < 0:
                out += self.unknown(s[at - 1])
                at -= 1
            else:
                out.append(token)
                at -= len(piece[token])
        return array("i", out[::-1]).tobytes()

    def unknown(self, char: str) -> list[int]:
        """A character without a piece, its ids backwards; -1 where the model has no byte pieces."""
        return [self.v.id_of_byte[b] for b in reversed(char.encode())] if self.v.id_of_byte else [-1]

    def spell(self, s: str) -> bytes:
        return b"".join([self.known[x] if len(x) <= SHORT else self.stretch(x) for x in self.stretches(s)])

    def word(self, rest: str) -> bytes:
        return self.spell(MARK + rest)

    def encode(self, text: str | None, bos: bool = False, eos: bool = True) -> np.ndarray:
        """Ids of a whole text (None: the empty text)."""
        normal = self.v.lib.normalize(text) if text else ""
        if not normal:
            found = b""
        elif self.whole:
            found = self.spell(normal)
        else:
            # a mark begins a stretch, but for one right after another mark
            head, *rest = normal.split(MARK)
            if MARK + MARK in normal:
                rest = [x[1:] for x in re.findall(f"{MARK}+[^{MARK}]*", normal)]
            words = self.words
            found = self.spell(head) + b"".join([words[x] if len(x) <= SHORT else self.word(x) for x in rest])
        ids = np.frombuffer(found, np.int32)
        if not self.v.id_of_byte:           # one unknown id for each run of such characters
            ids = np.where(ids < 0, self.v.unk, ids)[~((ids < 0) & np.append(False, ids[:-1] < 0))] if len(ids) else ids
        return np.concatenate([[self.v.bos] * bos, ids, [self.v.eos] * eos]).astype(np.int32)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.text = [p.replace(MARK, " ") for p in v.piece]
        for i in v.control:
            self.text[i] = ""
        for i, b in v.byte_of.items():      # of a byte that is a character by itself; others are read in runs
            self.text[i] = chr(b) if b < 128 else ""
        self.text[v.unk] = UNKNOWN_TEXT
        self.high = np.array([v.byte_of.get(i, 0) > 127 for i in range(len(v.piece))])
        self.silent = np.array([i in v.control for i in range(len(v.piece))])
        self.marked = np.array([p.startswith(MARK) for p in v.piece])

    def spelt(self, run: list[int]) -> str:
        """Text of a run of byte pieces; every byte outside valid UTF-8 becomes U+FFFD."""
        raw, out = bytes(self.v.byte_of[i] for i in run), []
        while raw:
            try:
                out.append(raw.decode())
                break
            except UnicodeDecodeError as e:
                out.append(raw[:e.start].decode() + "�")
                raw = raw[e.start + 1:]
        return "".join(out)

    def decode(self, ids: np.ndarray | list[int] | None) -> str:
        """The text of ids; the blank that encoding put first is taken off."""
        ids = np.array([] if ids is None else ids, np.int64)
        if not len(ids):
            return ""
        if self.high[ids].any():
            out, run = [], []
            for i in ids.tolist():
                if i in self.v.byte_of:
                    run.append(i)
                    continue
                if run:
                    out.append(self.spelt(run))
                    run = []
                out.append(self.text[i])
            out.append(self.spelt(run))
            whole = "".join(out)
        else:
            whole = "".join(map(self.text.__getitem__, ids.tolist()))
        first = ids[np.argmax(~self.silent[ids])]
        return whole[1:] if self.v.leading and self.marked[first] else whole


def _appended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def _proto(path: str) -> bytes:
    with open(path, "rb") as f:         # a vocabulary file on the driver, of fixed size; tasks get its bytes
        return f.read()


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", bos: bool = False, eos: bool = True,
           keep_text: bool = False) -> DataFrame:
    """``docs`` without its text (unless ``keep_text``) and with its ids, array<int>.

    NULL and empty texts give the control ids alone.  Every row is encoded by
    itself, repeated ones alike; an empty table gives no rows.  A column of the
    caller's that is called ``ids_col`` is replaced.
    """
    spark = on_workers(docs.sparkSession)
    proto = spark.sparkContext.broadcast(_proto(model_path))
    keep = [c for c in docs.columns if c.lower() != ids_col.lower() and (keep_text or c.lower() != text_col.lower())]
    kept = docs.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(proto.value))
        for b in batches:
            offsets, parts = [0], []
            for text in b.column(1).to_pylist():
                ids = encoder.encode(text, bos, eos)
                parts.append(ids)
                offsets.append(offsets[-1] + len(ids))
            flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))], ["row", "ids"])

    out = kept.mapInArrow(run, _appended(kept.select("row"), "ids", T.ArrayType(T.IntegerType())))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("ids").alias(ids_col))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids (NULL ids: the empty text)."""
    spark = on_workers(encoded.sparkSession)
    proto = spark.sparkContext.broadcast(_proto(model_path))
    keep = [c for c in encoded.columns if c.lower() != text_col.lower()]
    kept = encoded.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{ids_col}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(proto.value))
        for b in batches:
            texts = [decoder.decode(x.values.to_numpy() if x.is_valid else None) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["row", "text"])

    out = kept.mapInArrow(run, _appended(kept.select("row"), "text", T.StringType()))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("text").alias(text_col))


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of encoded and decoded rows."""
    return encoded.select(
        F.col(id_col).alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
