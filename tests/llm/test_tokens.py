"""Token files, encoding, archives and exact search against the libraries and brute force."""

import base64
import gzip
import hashlib
import math
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tremorlake.llm import backtracking, bpe, chunks, shards, token_files, topk, warc
from tremorlake.llm.backtracking import WordVocabulary
from tremorlake.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n", "Hello,  World's é 12345 ΣΑΣ İ <|endoftext|>x", "a" * 3000, "x\x1cy\u0085z ՘", "don't 'LL <|startoftext|>", "hello world"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_backtracking_equals_the_library(library):
    ours, rng = WordVocabulary(PATH), random.Random(1)
    words = ["".join(rng.choice("abcdehilnorstßéÀ") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    every = [chr(c) + "a" + chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for text in [t or "" for t in TEXTS] + words + every:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = ours.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, repr(text)
        assert ours.decode(packed).decode() == library.decode(ids, skip_special_tokens=False)


def test_columns(table, library):
    df = table([(i, t, b"") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids binary")
    rows = bpe.digests(df).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        whole = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert bpe.digests(df.limit(0)).count() == 0


ODD = ["", None, " \n", "Über ÜBER über,", "x\x1cy\u0085z\u2003w\x0bv\x0cu", "e\u0301 \u0301e Ǆ Ŀ ŀ ŉ İi ſ ẞß", "a*** b$$$ c%%% d&&& e### #f &amp; g.#*", "<|endoftext|> q<|endoftext|>r <|", "don't 'LL I'm", "z" * 200]


def test_library_encoder_asks_once_for_each_chunk(library, monkeypatch):
    """Blocks of a few bytes, nulls, repeated chunks, white space of other kinds: the whole text's ids by the library."""
    monkeypatch.setattr(chunks, "BLOCK", 40)
    encoder, texts = token_files.LibraryEncoder(PATH), ODD * 2 + ["new Word word! " * 30]
    blocks = list(chunks.blocks(pa.array([None, *texts])[1:]))
    assert len(blocks) > 5 and [n for n, _ in blocks] == np.cumsum([0, *(len(b) for _, b in blocks)])[:-1].tolist()
    packed = [ids for _, block in blocks for ids in encoder.encode(block).to_pylist()]
    assert [np.frombuffer(p, "<u2").tolist() for p in packed] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    asked = []
    chunks.joined_ids(pa.array(["b a b", "a"], pa.large_string()), lambda some: asked.append(some) or [b""] * len(some))
    assert asked == [["b", "a"]]
    assert chunks.joined_ids(pa.array([], pa.large_string()), lambda some: []).to_pylist() == []


def test_words_beyond_one_generation_and_block(library, monkeypatch):
    """Few strings are held, blocks are short, and chunks are their own words, other words or many."""
    monkeypatch.setattr(chunks, "BLOCK", 40)
    monkeypatch.setattr(backtracking, "_STRINGS", 5)
    ours, texts = WordVocabulary(PATH), ODD * 2 + ["new Word word! \x01a " * 30]
    packed = [ids for _, block in chunks.blocks(pa.array(texts)) for ids in chunks.joined_ids(block, ours.encode_all).to_pylist()]
    assert packed == [ours.encode(t or "") for t in texts]
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(ours.strings.young) <= 5 and len(ours.strings.old) <= 5


def test_token_files(spark, table, library):
    keys = [5, 3, None, 9, 9, 7, 1, 2]
    df = table(list(zip(keys, TEXTS)), "doc_id long, text string")
    index = token_files.write_token_files(df, new_path(spark, "t"))
    read = token_files.read_token_files(index).join(token_files.file_starts(index), "shard")
    start, seen = 0, sorted(read.collect(), key=lambda r: r.file_start + r.shard_start)
    assert [r.doc_id for r in seen] == sorted(keys, key=lambda k: (k is not None, k or 0))
    for row in seen:
        assert row.file_start + row.shard_start == start
        start += len(row.ids) // 4
    by_key = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for k, t in zip(keys, TEXTS) if k != 9}
    assert all(bytes(r.ids) == by_key[r.doc_id] for r in seen if r.doc_id != 9)
    places = index.filter("record >= 0").orderBy("n_tokens")
    assert {bytes(r.ids) for r in token_files.read_at(places).collect()} == {bytes(r.ids) for r in seen}
    assert token_files.write_token_files(df.limit(0), new_path(spark, "t")).count() == 0
    with pytest.raises(ValueError):
        import io

        token_files.record_at(io.BytesIO(token_files.framed(b"abc")[:-1] + b"\0"))


def test_archives(spark, table):
    pages = ["a" * 2_500_000, "", None, "é", "a" * 2_500_000, "é", "z"]
    df = table([(i, f"http://x/\n{i}", h, "p") for i, h in enumerate(pages)] + [(None, None, "z", "p")], "page_id long, url string, html string, path string")
    places = warc.write_warc(df, new_path(spark, "w"))
    for place in places.collect():
        with gzip.open(place.path.removeprefix("file:"), "rb") as archive:
            assert archive.read(8) == b"WARC/1.1"
        with open(place.path.removeprefix("file:"), "rb") as archive:
            archive.seek(place.offset)
            assert archive.read(2) == b"\x1f\x8b"
    chunks = warc.read_chunks(places)
    rows = {r.page_id: r for r in chunks.filter("last").collect()}
    assert len(rows) == 8 and rows[None].refers_to == 6
    for i, html in enumerate(pages):
        data = (html or "").encode()
        first = min(j for j, h in enumerate(pages) if (h or "") == (html or ""))
        row = rows[i]
        assert row.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode() and row.payload_bytes == len(data)
        assert (row.record_type, row.refers_to) == (("response", None) if first == i else ("revisit", first))
        if first == i:
            assert (row.bytes_so_far, row.sha1_so_far) == (len(data), hashlib.sha1(data).hexdigest())
    assert chunks.filter("page_id = 0").count() == 3
    assert warc.write_warc(df.limit(0), new_path(spark, "w")).count() == 0


def test_long_files_are_read_in_parts(spark, table, monkeypatch):
    """The tasks that read back follow from the bytes; a file is cut where its records begin."""
    monkeypatch.setattr(shards, "SEGMENT", 2000)
    texts = [f"some words of text number {n} " * (n % 50) for n in range(300)]
    df = table(list(enumerate(texts)), "doc_id long, text string")
    index = token_files.write_token_files(df, new_path(spark, "t"))
    read = token_files.read_token_files(index)
    tasks = shards.segments(index, []).rdd.getNumPartitions()
    assert tasks > 10 and read.rdd.getNumPartitions() == tasks
    whole = {(r.shard, r.record): r for r in read.collect()}
    places = {(r.shard, r.record): r for r in index.collect()}
    assert whole.keys() == places.keys() and len(whole) == 300
    assert all(whole[k].doc_id == p.doc_id and whole[k].shard_start == p.shard_start for k, p in places.items())
    assert all(len(whole[k].ids) == 4 * p.n_tokens for k, p in places.items())
    pages = table([(n, f"u{n}", t) for n, t in enumerate(texts)], "page_id long, url string, html string")
    archives = warc.write_warc(pages, new_path(spark, "w"))
    chunks = warc.read_chunks(archives)
    assert chunks.rdd.getNumPartitions() > 5
    assert sorted(r.page_id for r in chunks.filter("last").collect()) == list(range(300))


def test_places():
    assert shards.place("/a/b")[1] == shards.place("file:///a/b")[1] == "/a/b"


def test_impact_index():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, dims, most = int(rng.integers(1, 200)), int(rng.integers(1, 9)), int(rng.choice([1, 3, 50, 1000]))
        vectors, ids = rng.integers(-most, most + 1, (n, dims)), rng.integers(0, max(2, n), n)
        query, own, k = rng.integers(-most, most + 1, dims), int(rng.integers(0, n)), int(rng.integers(1, 12))
        places, scores = topk.ImpactIndex(ids, vectors).top_k(query, own, k)
        order = np.argsort(ids, kind="stable")
        exact = vectors[order] @ query
        best = sorted((i for i in range(n) if ids[order][i] != own), key=lambda i: (-exact[i], i))[:k]
        assert list(places) == best and list(scores) == [exact[i] for i in best]


def _asked(rows, vec_id, k):
    """Ids and exact scores by plain whole numbers."""
    whole = {i: [max(-(1 << 63), min((1 << 63) - 1, math.floor(1024.0 * x))) for x in v] for i, v in rows}
    scores = {i: sum(a * b for a, b in zip(v, whole[vec_id])) for i, v in whole.items() if i != vec_id}
    best = sorted(scores, key=lambda i: (-scores[i], i))[:k]
    return [(i, scores[i] if -(1 << 63) <= scores[i] < 1 << 63 else None) for i in best]


@pytest.mark.parametrize("large", [1e6, 1e12, 1e300])
def test_components_of_any_size(table, large):
    """A block with large components, in one block and over many, next to small ones and scores beyond 63 bits."""
    rng = np.random.default_rng(7)
    rows = [(n, rng.normal(size=64).tolist()) for n in range(120)]
    rows += [(120, [large] * 64), (121, [-large] * 64), (122, [large] + [0.0] * 63), (123, [large] * 64), (124, [0.0] * 64)]
    df = table(rows, "vec_id long, embedding array<double>")
    for blocks in ({}, {"block_rows": 20, "block_queries": 1}):
        found = topk.top_k(df, df.filter("vec_id in (0, 7, 120, 122)"), k=8, **blocks).collect()
        for query in (0, 7, 120, 122):
            got = [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == query]
            assert got == _asked(rows, query, 8)


def test_topk_edges(table):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [9.0, 9.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [1.0])]
    df = table(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, df.filter("vec_id = 0"), k=3).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [None, 1, 2]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
