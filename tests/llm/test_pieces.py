"""SentencePiece merge rounds against the library: random texts, long stretches, round trips."""

import random

import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ratewise.llm import pieces

MODEL = P.path("piece_bpe_32k.model")
PARTS = [*"aeionrsth ▁\n\t\r.,é日本語𐍈\x00the<>0123", "  ", "   ", "the", " of", "▁▁▁▁", " ", "﻿", "é", "</s>", "<0x41>"]


@pytest.fixture(scope="module")
def both():
    return pieces.PieceCodec(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("length", [1, 8, 60, 400])
def test_equals_the_library(both, length):
    mine, lib = both
    rng = random.Random(length)
    for _ in range(60):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, length))) for _ in range(20)]
        ids = mine.encode(texts)
        assert ids == lib.encode(texts, add_eos=True)
        assert [mine.decode(x) for x in ids] == [lib.decode(x) for x in ids]


def test_runs_of_spaces_and_long_words(both):
    mine, lib = both
    texts = [" " * n + tail for n in range(70) for tail in ("", "the", "日", "\n")]
    texts += [" " * 5000 + "x", "a" * 3000, "abcdefgh" * 600, "qx7" * 900 + " " * 2000, "the" * 1500]
    assert mine.encode(texts) == lib.encode(texts, add_eos=True)


def test_heap_and_rounds_agree(both, monkeypatch):
    mine, lib = both
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(90)) for _ in range(200)]
    monkeypatch.setattr(pieces, "LONG", 2)
    assert pieces.PieceCodec(MODEL).encode(texts) == lib.encode(texts, add_eos=True)


def test_words_are_remembered_up_to_a_bound(both):
    _, lib = both
    mine = pieces.PieceCodec(MODEL, remember=5)
    for text in ["one two three four five six seven", "one eight", "x" * 200 + " one"]:
        assert mine.encode([text]) == lib.encode([text], add_eos=True)
    assert all(len(w) <= pieces.REMEMBERED_CHARS for w in mine.words)


def test_decode_of_any_ids(both):
    mine, lib = both
    rng = random.Random(4)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 28705, 2]) for _ in range(rng.randint(0, 8))]
        assert mine.decode(ids) == lib.decode(ids)
    with pytest.raises(IndexError):
        mine.decode([40_000])
    with pytest.raises(ValueError):
        mine.decode([-1])


def test_begin_and_end_ids(both):
    mine, lib = both
    assert mine.encode(["a b", ""], bos=True, eos=False) == lib.encode(["a b", ""], add_bos=True)


def test_frames(spark, docs, both):
    out = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert out.where(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert out.count() == docs.count()
    for row in out.select("text", "ids").collect():
        assert row["ids"] == both[1].encode(row["text"] or "", add_eos=True)
    got = pieces.digests(docs, MODEL)
    assert got.count() == docs.count()
    assert got.where("doc_id = 4").distinct().count() == 1
    assert pieces.digests(docs.limit(0), MODEL).count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "id int, ids array<int>"), MODEL).first()["decoded"] == ""
    clash = docs.withColumn("IDS", F.lit(1))
    assert pieces.encode(clash, MODEL).columns[-1] == "_ids"
