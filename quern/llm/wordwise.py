"""Ids of texts put together from the ids of their words, each distinct word of a block looked up once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

WORDS_IN_BLOCK = 1 << 19
CHARS_AT_ONCE = 1 << 22


def runs(texts: list[str], chars: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``chars`` characters each; a longer text is a range of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def batched(library: Tokenizer, texts: list[str], n: int = 20) -> Iterator[list[int]]:
    """Ids of each text, ``n`` texts a call."""
    for k in range(0, len(texts), n):
        for e in library.encode_batch_fast(texts[k:k + n], add_special_tokens=False):
            yield e.ids


def ids_of_lists(words: pa.ListArray, ids_of: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """Ids of every list's words, one after another (little-endian unsigned 32-bit).

    ``ids_of`` gets the distinct words of a block.
    """
    flat, counts, parts = words.flatten(), [np.zeros(1, np.int64)], [np.zeros(0, "<u4")]
    for k in range(0, len(flat), WORDS_IN_BLOCK):
        block = flat.slice(k, WORDS_IN_BLOCK).dictionary_encode()
        which = block.indices.to_numpy()
        found = ids_of(block.dictionary.to_numpy(zero_copy_only=False).tolist())
        lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
        n = lens[which]
        ends = np.cumsum(n)
        # Where each id of the block lies among the ids of its distinct words.
        shift = ((np.cumsum(lens) - lens)[which] - (ends - n)).astype(np.int32 if ends[-1] < 1 << 30 else np.int64)
        at = np.arange(ends[-1], dtype=shift.dtype) + np.repeat(shift, n)
        parts.append(np.frombuffer(b"".join(found), "<u4")[at])
        counts.append(n)
    data = np.concatenate(parts).tobytes()
    places = words.offsets.to_numpy()
    bounds = (4 * np.cumsum(np.concatenate(counts)))[places - places[0]].tolist()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]
