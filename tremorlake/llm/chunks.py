"""Encoding of texts by their distinct white-space chunks, a bounded block of texts at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text whose chunks are looked up together, which bounds what one step holds.
BLOCK = 1 << 22


def blocks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive rows of about ``BLOCK`` bytes, with the number of the first; a larger text is alone or comes last."""
    import numpy as np

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while first < len(texts):
        begin = ends[first - 1] if first else 0
        last = min(int(np.searchsorted(ends, begin + BLOCK)) + 1, len(texts))
        yield first, texts[first:last]
        first = last


def joined_ids(texts: pa.Array, ids_of: Callable[[list[str]], list[bytes]]) -> pa.Array:
    """Per text the packed ids of its chunks one after the other; ``ids_of`` is asked once for each distinct chunk.

    Chunks end at ASCII white space, which ends words in both vocabularies; the empty one may be among them.
    """
    import numpy as np

    lists = pc.ascii_split_whitespace(texts)
    chunks = lists.values.dictionary_encode()
    ids = pa.array(ids_of(chunks.dictionary.to_pylist()), pa.large_binary())
    joined = ids.take(chunks.indices)
    _, places, packed = joined.buffers()
    # Chunks lie one after the other, so a text's ids are a stretch of the whole.
    starts = np.frombuffer(places, np.int64)[: len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
    bounds = np.ascontiguousarray(starts[lists.offsets.to_numpy()])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), packed or pa.py_buffer(b"")])
