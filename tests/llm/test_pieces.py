"""Piece encoding and decoding against the library."""
import hashlib
import os
import random

import pytest
import sentencepiece

from quayside.llm import pieces
from tests.llm.util import docs, with_extra

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "   ", "a", " a", "a  b   c", "\n\n\t x\r\n", "▁▁ a▁b", "<s> </s> <0x41> <unk>", "é中文 梦 😀👍🏽 ‍", "\x00\x01",
       "ﬁ Ａ　x", "x" * 3000 + "中" * 2000, " " * 1000 + "z", "2024-01-02T03:04:05Z 3.14 $5", "aaaa " * 2000, "²." * 7]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as f:
        return pieces.Vocabulary(f.read())


def random_texts(n):
    rng = random.Random(n)
    kinds = ["ab the and ing tion  \n\t▁0123é中文😀<>.,()--==ﬁ\xa0", "".join(map(chr, range(32, 127))), "aeiourstln   "]
    return ["".join(rng.choice(kinds[i % 3]) for _ in range(rng.randrange(60))) for i in range(n)]


def test_texts_as_the_library(vocabulary, library):
    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    for text in [t for t in ODD if t is not None] + random_texts(4000):
        want = library.encode(text, add_eos=True)
        assert encoder.encode(text).tolist() == want
        assert decoder.decode(want) == library.decode(want)
    assert encoder.encode("a b", bos=True, eos=False).tolist() == library.encode("a b", add_bos=True)


def test_any_ids_as_the_library(vocabulary, library):
    decoder, rng = pieces.Decoder(vocabulary), random.Random(2)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(3), rng.randrange(3, 259), rng.randrange(259, 32_000), 259]) for _ in range(rng.randrange(9))]
        assert decoder.decode(ids) == library.decode(ids)


def test_memos_that_forget_change_nothing(vocabulary, library, monkeypatch):
    for name in ("WORDS", "STRETCHES", "PAIRS"):
        monkeypatch.setattr(pieces, name, 5)
    encoder = pieces.Encoder(vocabulary)
    for text in random_texts(300):
        assert encoder.encode(text).tolist() == library.encode(text, add_eos=True)


def test_pairs_are_what_merging_leaves(vocabulary, library):
    """A token fits beside another exactly where the library leaves both whole."""
    encoder, rng = pieces.Encoder(vocabulary), random.Random(4)
    some = [i for i in range(259, 32_000) if pieces.MARK not in vocabulary.piece[i]]
    for _ in range(3000):
        a, b = rng.choice(some), rng.choice(some)
        want = library.encode(" " + vocabulary.piece[a] + vocabulary.piece[b])
        if want[:2] == [259, a] or want[:1] == [259]:       # the leading blanks stayed apart
            assert encoder.fits(a * pieces.PAIR + b) == (want == [259, a, b])


def test_operator(spark, library):
    texts = ODD + random_texts(50)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "twice"), (3, "twice"), (None, "no id")]
    df = with_extra(docs(spark, rows)).withColumnsRenamed({"lang": "ids", "source": "decoded"}).repartition(3)
    encoded = pieces.encode(df, MODEL)
    assert "text" not in encoded.columns and dict(encoded.dtypes)["ids"] == "array<int>"
    got = sorted(map(tuple, pieces.digest(pieces.decode(encoded, MODEL)).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert got == sorted(want, key=str)
    assert pieces.encode(docs(spark, []), MODEL).count() == 0
    assert "text" in pieces.encode(df, MODEL, keep_text=True).columns
    null_ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in pieces.decode(null_ids, MODEL).collect()] == ["", ""]


def test_whole_table(spark, library):
    """Every document of the test table, its digests as the library gives them."""
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test table")
    df = spark.read.parquet(path).select("doc_id", "text")
    got = {r.doc_id: tuple(r)[1:] for r in pieces.digest(pieces.decode(pieces.encode(df, MODEL), MODEL)).collect()}
    for r in df.collect():
        ids = library.encode(r.text or "", add_eos=True)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(library.decode(ids).encode()).hexdigest())
