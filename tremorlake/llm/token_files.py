"""Token ids as length-delimited binary records, with an index of offsets.

A record is: length (8 bytes), masked checksum of the length (4), payload, masked
checksum of the payload (4), all little-endian. The checksum is CRC-32, rotated right
by 15 bits plus a constant, so that a checksum over data with checksums in it stays
useful. The payload has the document id (1 byte flag, 8 bytes) and the ids, two bytes
each where the vocabulary allows, else four. Next to each file lies ``.idx`` with the
offset of every record, eight bytes each, for reads in any order.

Documents are written in ascending id order: files are ranges of ids, in order of
their number, and rows within a file ascend. Cases: null ids come first and are stored
as such; rows that repeat an id are ordered by a digest of their text, equal rows are
interchangeable and may spread over files; a null or empty text gives a record with
the end id alone; an empty table gives no file; extra columns are left behind.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.bpe import word_vocabulary
from tremorlake.llm.chunks import blocks, joined_ids
from tremorlake.llm.shards import new_file, open_at, open_buffered, qualified, segments
from tremorlake.llm.worker import Known, held
from tremorlake.operators.ranking import running_before
from tremorlake.session import cut_lineage, new_path

END_ID = 1
_MASK = 0xA282EAD8
_KNOWN = 160 << 20
# Marks that end a chunk and are words of their own after a letter of this range.
_MARKS = ".,;:!?#*$%&"
# Without the one letter whose lower case is two characters.
_LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]")
_WORD = re.compile(_LETTER.pattern + "+")
# Words of letters that are encoded in one call.
_TOGETHER = 1000
_FAN_OUT = 4096


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def record_at(stream) -> bytes | None:
    """The payload of the record that starts here; None at the end. A damaged record is an error."""
    head = stream.read(12)
    if not head:
        return None
    length, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError("the length of a record is damaged")
    body = stream.read(length + 4)
    payload = body[:length]
    if len(body) != length + 4 or masked(payload) != struct.unpack("<I", body[length:])[0]:
        raise ValueError("a record is damaged")
    return payload


def _stem_and_marks(chunk: str) -> tuple[str, str]:
    """Two parts that the vocabulary takes for words of their own; the second may be empty."""
    stem = chunk.rstrip(_MARKS)
    if not stem or not _LETTER.match(stem[-1]):
        stem = chunk
    return stem, chunk[len(stem) :]


class LibraryEncoder:
    """The tokenizers library behind a bounded table of white-space chunks.

    White space separates words in this vocabulary, so a text's ids are those of its
    chunks one after the other; each chunk is encoded by the library when first met.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # For lower-case words of letters: no normal form and no pattern, white space ends words.
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.normalizer = normalizers.Sequence([])
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), spelled])
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.known = Known(_KNOWN)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _learn(self, words: list[str], kind: str) -> None:
        """Encode words of letters in one call; each has one token with the mark of a word's end, its last."""
        import numpy as np

        (found,) = self.plain.encode_batch_fast([" ".join(words).lower()], add_special_tokens=False)
        ids = np.array(found.ids, kind)
        ends = (np.nonzero(self.ends[ids])[0] + 1) * ids.itemsize
        if len(ends) != len(words):
            raise ValueError("the vocabulary doesn't end each word with a token of its own")
        raw, cuts = ids.tobytes(), [0, *ends.tolist()]
        self.known.put_all(words, [raw[i:j] for i, j in zip(cuts, cuts[1:])])

    def encode(self, texts: pa.Array) -> pa.Array:
        found = joined_ids(texts, self._ids_of)
        self.known.trim()
        return found

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        kind = "I" if self.wide else "H"
        new = set(filterfalse(self.known.__contains__, chunks))
        words = list(filter(_WORD.fullmatch, new))
        # Any other chunk is a stem and the marks after it.
        parts = {c: _stem_and_marks(c) for c in new.difference(words)}
        more = set(filterfalse(self.known.__contains__, chain.from_iterable(parts.values()))).difference(words)
        stems = list(filter(_WORD.fullmatch, more))
        rest = list(more.difference(stems))
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.known.put_all(rest, [array(kind, x.ids).tobytes() for x in found])
        words += stems
        for first in range(0, len(words), _TOGETHER):
            self._learn(words[first : first + _TOGETHER], kind)
        whole = [c for c, (_, marks) in parts.items() if marks]
        self.known.put_all(whole, [self.known[stem] + self.known[marks] for stem, marks in map(parts.get, whole)])
        return list(map(self.known.__getitem__, chunks))


INDEX = "shard int, path string, record bigint, doc_id bigint, offset bigint, n_tokens bigint, shard_start bigint"
RECORDS = "shard int, record bigint, doc_id bigint, shard_start bigint, ids binary"


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode and write; returns the stored index: a row per record with its place."""
    path = path or word_vocabulary()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = held(("library encoder", path), lambda: LibraryEncoder(path))
        width = 4 if encoder.wide else 2
        end = struct.pack("<I" if encoder.wide else "<H", end_id)
        shard = TaskContext.get().partitionId()
        names = INDEX.split(", ")
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def rest():
            yield first
            yield from batches

        with new_file(folder, ".ids") as (name, out), new_file(folder, ".idx") as (_, index):
            offset = record = start = 0
            for batch in rest():
                keys = batch.column(0).to_pylist()
                for begin, block in blocks(batch.column(1)):
                    rows = []
                    for key, ids in zip(keys[begin : begin + len(block)], encoder.encode(block).to_pylist()):
                        payload = struct.pack("<?Bq", key is not None, width, key or 0) + ids + end
                        out.write(frame := framed(payload))
                        index.write(struct.pack("<Q", offset))
                        n = len(ids) // width + 1
                        rows.append((shard, name, record, key, offset, n, start))
                        offset, record, start = offset + len(frame), record + 1, start + n
                    columns = [list(c) for c in zip(*rows)]
                    types = [pa.int32(), pa.string(), *[pa.int64()] * 5]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types)], [n.split()[0] for n in names]
                    )

    folder = qualified(docs.sparkSession, folder)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    digest, tie = F.xxhash64("text"), F.monotonically_increasing_id()
    # The tie lets rows that are equal in all else spread over ranges.
    ordered = keyed.withColumns({"digest": digest, "tie": tie})
    ranged = ordered.repartitionByRange("doc_id", "digest", "tie").sortWithinPartitions("doc_id", "digest", "tie")
    return cut_lineage(ranged.select("doc_id", "text").mapInArrow(write, INDEX), "token-index")


def _decoded(payload: bytes) -> tuple[int | None, bytes]:
    import numpy as np

    has_key, width, key = struct.unpack_from("<?Bq", payload)
    ids = np.frombuffer(payload, "<u4" if width == 4 else "<u2", offset=10)
    return (key if has_key else None), ids.astype("<u4").tobytes()


def _batches(rows: Iterator[tuple[int, int, int | None, bytes]], most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows of RECORDS in batches of bounded bytes."""
    held_rows, size = [], 0

    def batch():
        columns = zip(*held_rows)
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [n.split()[0] for n in RECORDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    for shard, record, start, (key, ids) in rows:
        held_rows.append((shard, record, key, start, ids))
        size += len(ids) + 64
        if size >= most:
            yield batch()
            held_rows, size = [], 0
    if held_rows:
        yield batch()


def read_token_files(index: DataFrame) -> DataFrame:
    """Every record of the files that the index names, each part of a file read once from front to back.

    The index says where records begin, so a long file is cut there and read by several tasks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                columns = [batch.column(n).to_pylist() for n in ("path", "begin", "n", "shard", "record", "shard_start")]
                for path, begin, n, shard, record, start in zip(*columns):
                    with open_buffered(path, begin) as stream:
                        for _ in range(n):
                            key, ids = _decoded(record_at(stream))
                            yield shard, record, start, (key, ids)
                            record, start = record + 1, start + len(ids) // 4

        yield from _batches(rows())

    return segments(index, ["shard", "record", "shard_start"]).mapInArrow(read, RECORDS)


def read_at(places: DataFrame) -> DataFrame:
    """The records at given places (``shard, record, path, offset``), in any order: for shuffled reads."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            files = {}
            for batch in batches:
                for shard, record, path, offset in zip(*[batch.column(n).to_pylist() for n in range(4)]):
                    if path not in files:
                        if len(files) >= 64:
                            files.pop(next(iter(files))).close()
                        files[path] = open_at(path)
                    files[path].seek(offset)
                    yield shard, record, None, _decoded(record_at(files[path]))

        yield from _batches(rows())

    return places.select("shard", "record", "path", "offset").mapInArrow(read, RECORDS)


def file_starts(index: DataFrame) -> DataFrame:
    """``shard, file_start``: ids in all files before each file, by running sums of file totals."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    levelled = totals.withColumn("block", F.floor(F.col("shard") / _FAN_OUT))
    before = running_before(levelled, ["tokens"], ["shard"], levels=["block"])
    return cut_lineage(before.select("shard", F.col("tokens_before").alias("file_start")), "file-starts")


def op9_token_files(spark, sf_dir):
    """Every document's record, written to token files and read back: its place among all ids, its length, its checksum.

    A null text gives the end id alone; null ids come first; an empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = write_token_files(docs, new_path(spark, "token-files"))
    read = read_token_files(index).select(
        "shard",
        "doc_id",
        "shard_start",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    start = F.col("file_start") + F.col("shard_start")
    return read.join(file_starts(index), "shard").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
