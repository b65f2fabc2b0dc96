"""Encoding and decoding with merge-type SentencePiece vocabularies.

An encoding starts from single characters. An agenda holds every pair of neighbours whose
joined text is a piece, the best score first and the leftmost of equal ones. The best pair
is joined, its two new neighbourhoods join the agenda, and entries of symbols that have been
joined since are passed over, until the agenda is empty. Symbols that are no piece fall
back to their bytes.

No merge goes over a border that no piece goes over. In a vocabulary whose pieces have the
space at the front only, those are the places before a run of spaces, around line ends, and
between a letter and a punctuation mark that follows no letter in any piece. So
a text is cut there, each chunk is encoded when it is first met, and all first-met chunks
of an Arrow batch are held against the library in one call; a difference is an error.

Decoding copies each id's bytes from a table of offsets. Cases: a null or empty text has no ids,
and no ids decode to the empty text; a null id is passed over; control ids have no text; bytes
that make no character become U+FFFD each; names of control symbols in a text are ordinary
text; texts of any length are encoded whole, and a chunk of any length has one agenda;
repeated rows are encoded one by one; other columns never leave the JVM, and a column of the
result's name is replaced; empty tables stay empty.
"""

from __future__ import annotations

import codecs
import heapq
import re
import string
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.worker import Known, held

SPACE = "▁"
# Characters encoded at a time, ids decoded at a time, and bytes of chunks known to a worker.
BLOCK, IDS, KNOWN = 1 << 20, 1 << 16, 64 << 20
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_UNKNOWN = " ⁇ "


def piece_model() -> str:
    """Path of the public model; it is the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def agenda(symbols: list[str], rank: dict[str, int]) -> list[str]:
    """Join neighbours, the least rank first and then the leftmost, until no joined text has a rank."""
    n = len(symbols)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    todo = []
    for left in range(n - 1):
        both = symbols[left] + symbols[left + 1]
        if both in rank:
            todo.append((rank[both], left, left + 1, len(both)))
    heapq.heapify(todo)
    while todo:
        _, left, right, size = heapq.heappop(todo)
        one, other = symbols[left], symbols[right]
        # Symbols only grow or vanish, so an entry is stale if the lengths don't add up.
        if not one or not other or len(one) + len(other) != size:
            continue
        symbols[left], symbols[right] = one + other, ""
        last = following[left] = following[right]
        if last < n:
            before[last] = left
            both = symbols[left] + symbols[last]
            if both in rank:
                heapq.heappush(todo, (rank[both], left, last, len(both)))
        first = before[left]
        if first >= 0:
            both = symbols[first] + symbols[left]
            if both in rank:
                heapq.heappush(todo, (rank[both], first, left, len(both)))
    return [s for s in symbols if s]


def _cuts(merges: Iterable[str]) -> str:
    """A pattern of chunks: no piece goes over the border of two."""
    if any(" " in t.lstrip(" ") or "\n" in t for t in merges):
        return r"[\s\S]+"
    letter = re.compile(f"[{_LETTERS}]")
    after_letters = {b for t in merges for a, b in zip(t, t[1:]) if letter.match(a)}
    marks = "".join(sorted(set(string.punctuation) - after_letters))
    words = ""
    if marks:
        marks = re.escape(marks)
        # Letters, or marks and letters, that end before a mark, a space or a line end.
        words = f" *+(?:[{_LETTERS}]++|[{marks}]++[{_LETTERS}]*+)(?![^ \\n{marks}])|"
    return words + r" *[^ \n]+| +|\n+"


class PieceVocabulary:
    """A model file: ranks of pieces, byte pieces, the cutting rule and the decoding table."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as file:
            model = proto.ModelProto.FromString(file.read())
        kinds = proto.ModelProto.SentencePiece
        normal, trainer = model.normalizer_spec, model.trainer_spec
        found = {p.type for p in model.pieces}
        if (
            trainer.model_type != proto.TrainerSpec.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not normal.escape_whitespaces
            or found & {kinds.USER_DEFINED, kinds.UNUSED}
        ):
            raise ValueError(f"{path}: not a merge-type vocabulary with byte fallback and plain spaces")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = " " if normal.add_dummy_prefix else ""
        # The space symbol and a space are the same to the model; in here both are a space.
        merges = {p.piece.replace(SPACE, " "): (i, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        places = {s: n for n, s in enumerate(sorted({s for _, s in merges.values()}, reverse=True))}
        self.ids = {t: i for t, (i, _) in merges.items()}
        self.rank = {t: places[s] for t, (_, s) in merges.items()}
        self.bytes = [0] * 256
        entries, self.control, self.byte_ids = [], set(), set()
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                self.bytes[value] = i
                self.byte_ids.add(i)
                entries.append(bytes([value]))
            elif p.type == kinds.CONTROL:
                self.control.add(i)
                entries.append(b"")
            else:
                entries.append((_UNKNOWN if p.type == kinds.UNKNOWN else p.piece.replace(SPACE, " ")).encode())
        self.spaced = {i for i, e in enumerate(entries) if e.startswith(b" ") and model.pieces[i].type == kinds.NORMAL}
        self.blob = b"".join(entries)
        self.offsets = array("q", [0])
        for e in entries:
            self.offsets.append(self.offsets[-1] + len(e))
        self.chunks = re.compile(_cuts(merges))
        # A line end before a chunk keeps the library from adding its own space to it.
        self.lead = self.library.encode("\n")
        self.known = Known(KNOWN)

    def chunk_ids(self, chunk: str) -> list[int]:
        found = self.ids.get(chunk)
        if found is not None and len(chunk) == 1:
            return [found]
        out = []
        for symbol in agenda(list(chunk), self.rank):
            number = self.ids.get(symbol)
            if number is None:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(number)
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks that are met for the first time, and hold them against the library."""
        ours = [self.chunk_ids(c) for c in chunks]
        theirs = self.library.encode(["\n" + c for c in chunks], num_threads=1)
        for chunk, ids, whole in zip(chunks, ours, theirs):
            if whole[len(self.lead) :] != ids or whole[: len(self.lead)] != self.lead:
                raise ValueError(f"the library encodes {chunk!r} in another way")
            self.known.put(chunk, array("i", ids).tobytes())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, four bytes each."""
        find, prefix = self.chunks.findall, self.prefix
        split = [find(prefix + t.replace(SPACE, " ")) if t else [] for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(sorted(new))
        get = self.known.__getitem__
        out = [b"".join(map(get, chunks)) for chunks in split]
        self.known.trim()
        return out

    def _text(self, ids, raw: bool) -> bytes:
        """The bytes of ids one after the other; ``raw`` if there are bytes among them that may make no character."""
        import numpy as np

        blob, offsets = np.frombuffer(self.blob, np.uint8), np.frombuffer(self.offsets, np.int64)
        if raw and (control := np.isin(ids, list(self.control))).any():
            # Control symbols have no text, yet bytes on both sides of one make no character together.
            runs = np.split(np.arange(len(ids)), np.nonzero(control)[0])
            return b"".join(self._text(ids[run[~control[run]]], True) for run in runs)
        parts = []
        for first in range(0, len(ids), IDS):
            some = ids[first : first + IDS]
            starts = offsets[some]
            lengths = offsets[some + 1] - starts
            ends = np.cumsum(lengths)
            parts.append(blob[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])].tobytes())
        text = b"".join(parts)
        return text.decode("utf-8", "tremorlake_one_each").encode() if raw else text

    def decode(self, ids) -> bytes:
        """UTF-8 text of an array of ids."""
        import numpy as np

        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.offsets) - 1):
            raise ValueError("an id is not in the vocabulary")
        text = self._text(ids, bool(np.isin(ids, self.bytes[0x80:]).any()))
        # The model's own space before a text goes; control symbols before it don't count.
        head = next((int(i) for i in ids if int(i) not in self.control), None)
        return text[1:] if self.prefix and head in self.spaced else text


def _vocabulary(path: str) -> PieceVocabulary:
    codecs.register_error("tremorlake_one_each", _one_each)
    return held(("piece vocabulary", path), lambda: PieceVocabulary(path))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of a bounded number of bytes; a longer text is one of its own."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // BLOCK
    cuts = np.nonzero(np.diff(part))[0] + 1
    for first, last in zip([0, *cuts], [*cuts, len(texts)]):
        yield texts.slice(first, last - first)


def _ids(vocabulary: PieceVocabulary, texts: pa.Array) -> pa.ListArray:
    import numpy as np

    packed = vocabulary.encode([t or "" for t in texts.to_pylist()])
    ends = np.cumsum([0, *map(len, packed)]) // 4
    values = pa.array(np.frombuffer(b"".join(packed), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _texts(vocabulary: PieceVocabulary, rows: pa.ListArray) -> pa.Array:
    import numpy as np

    out = []
    for row in rows:
        ids = row.values
        ids = np.empty(0, np.int32) if ids is None else ids.drop_null().to_numpy(zero_copy_only=False)
        out.append(vocabulary.decode(ids))
    return pa.array(out, pa.string())


def encoded(text: str | Column, path: str) -> Column:
    """Ids of a text column."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        vocabulary = _vocabulary(path)
        return pa.concat_arrays([_ids(vocabulary, part) for part in _slices(texts)])

    return encode(text)


def decoded(ids: str | Column, path: str) -> Column:
    """Text of a column of ids."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        return _texts(_vocabulary(path), rows)

    return decode(ids)


def round_trip(text: str | Column, path: str) -> Column:
    """``ids`` of a text column and the text ``decoded`` from them, in one visit to a worker."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        vocabulary, ids, back = _vocabulary(path), [], []
        for part in _slices(texts):
            ids.append(_ids(vocabulary, part))
            back.append(_texts(vocabulary, ids[-1]))
        return pa.StructArray.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(back)], ["ids", "decoded"])

    # Else it would run once for each field that is taken.
    return both.asNondeterministic()(text)


def encode_texts(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    return docs.withColumn(ids, encoded(F.col(f"`{text}`"), path or piece_model()))


def decode_ids(docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    return docs.withColumn(text, decoded(F.col(f"`{ids}`"), path or piece_model()))


def op12_pieces(spark, sf_dir):
    """Every document's number of ids, and digests of its ids and of the text decoded from them.

    A null text is an empty one; rows that repeat an id are rows of their own; an empty table gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = docs.select("doc_id", round_trip("text", piece_model()).alias("both"))
    return both.select(
        "doc_id",
        F.size("both.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("both.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("both.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
