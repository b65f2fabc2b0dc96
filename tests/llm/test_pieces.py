"""Piece encoding and decoding against the library, on texts, single characters and random ids."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from tremorlake.llm import pieces
from tremorlake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "  ", "\n", "\na", " \n a\n\n b ", "▁x▁▁y", "<s> </s> <unk> <0x0A>", "a\x00b", "\t\tx", "\r\n x",
    "日本語のテキスト 中文", "é", "😀👍🏽 ok", "a" * 5000, "abc " * 3000, "end.\nStart", "﻿", "x" + " " * 70 + "y",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.piece_model())


@pytest.fixture(scope="module")
def ours():
    return pieces._vocabulary(pieces.piece_model())


def test_agenda_takes_the_best_pair_first():
    rank = {"bc": 0, "ab": 1, "aa": 3}
    assert pieces.agenda(list("abc"), rank) == ["a", "bc"]
    assert pieces.agenda(list("aaa"), rank) == ["aa", "a"]  # the leftmost of equal ones
    assert pieces.agenda([], rank) == []
    assert pieces.agenda(list("abxabc"), {"ab": 0, "abc": 1}) == ["ab", "x", "abc"]


def test_encoding_equals_the_library(ours, library):
    rng = random.Random(1)
    made = ["".join(rng.choice("ab c▁\n é日😀\t<s>01.,") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    every = [chr(c) + "a " + chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = [t or "" for t in TEXTS] + made + every
    for text, packed, ids in zip(texts, ours.encode(texts), library.encode(texts, num_threads=1)):
        mine = np.frombuffer(packed, np.int32)
        assert mine.tolist() == ids, repr(text)
        assert ours.decode(mine).decode() == library.decode(ids)


def test_without_cuts_the_ids_are_the_same(ours):
    """One agenda over a whole text gives what the chunks give."""
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("the quick\n over.  ") for _ in range(rng.randint(1, 200)))
        assert ours.chunk_ids(" " + text) == np.frombuffer(ours.encode([text])[0], np.int32).tolist()


def test_decoding_equals_the_library(ours, library):
    rng = random.Random(3)
    some = [0, 1, 2, 13, 259, 29871, *range(3, 259), *range(260, 400)]
    for _ in range(20_000):
        ids = [rng.choice(some) for _ in range(rng.randint(0, 8))]
        assert ours.decode(np.array(ids, np.int32)).decode() == library.decode(ids), ids
    with pytest.raises(ValueError):
        ours.decode(np.array([10**6]))


def test_known_chunks_are_bounded(ours, library):
    small = pieces.PieceVocabulary(pieces.piece_model())
    small.known = pieces.Known(2000)
    texts = [f"word{n} another{n}" for n in range(200)]
    for text in texts:
        (packed,) = small.encode([text])
        assert np.frombuffer(packed, np.int32).tolist() == library.encode(text)
        assert small.known.bytes <= 2000


def test_a_difference_from_the_library_is_an_error(ours):
    wrong = pieces.PieceVocabulary(pieces.piece_model())
    del wrong.rank[" the"]
    with pytest.raises(ValueError, match="in another way"):
        wrong.encode(["the"])


def test_columns(table, library):
    rows = [(i, t, "mine") for i, t in enumerate(TEXTS)] + [(0, "twin", "mine")] * 2
    df = table(rows, "doc_id long, text string, ids string")
    found = pieces.decode_ids(pieces.encode_texts(df)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert list(row.ids) == library.encode(row.text or "")
        assert row.decoded == library.decode(list(row.ids))
    nulls = df.selectExpr("if(doc_id = 0, null, array(1, null, 260, 13)) ids").limit(3)
    assert {r.decoded for r in pieces.decode_ids(nulls).collect()} <= {"", library.decode([1, 260, 13])}
    assert pieces.encode_texts(df.limit(0)).count() == 0


@pytest.mark.skipif(not Path(DATA).exists(), reason="driver data is absent")
def test_the_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op12_pieces"](spark, DATA).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
