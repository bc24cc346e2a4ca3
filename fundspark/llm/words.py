"""Words of whole Arrow columns at once: numpy finds the borders, Arrow gives distinct words codes.

Nothing here loops over words. All rules tell bytes below 128 apart and leave the others inside
words, so UTF-8 needs no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 8 << 20
WORD, SPACE, BREAK = 0, 1, 2

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_kinds(space: bytes, breaks: bytes = b"") -> np.ndarray:
    """Kind of each byte; what is not named belongs to words."""
    kinds = np.full(256, WORD, np.uint8)
    kinds[list(space)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """Words of a block of texts: ``words[codes[i]]`` stands in text ``doc[i]``.

    ``piece`` grows at every break, so neighbours belong together if text and piece are equal.
    """

    doc: np.ndarray
    codes: np.ndarray
    words: pa.Array
    piece: np.ndarray

    def joined(self) -> np.ndarray:
        """Whether the next word follows in the same piece."""
        same = np.zeros(len(self.doc), bool)
        same[:-1] = (self.doc[1:] == self.doc[:-1]) & (self.piece[1:] == self.piece[:-1])
        return same


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where its texts begin and end."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, content = texts.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)
    ends = ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def bounded(batch: pa.RecordBatch, text: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes; a longer text is a slice of its own."""
    _, offsets = column_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive strings of these lengths."""
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def encode(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and the distinct words they stand for."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def split_words(texts: pa.Array, kinds: np.ndarray, *, lower: bool = True) -> Words:
    """Words of every text; A-Z in lower case if ``lower``."""
    data, offsets = column_bytes(texts)
    kind = kinds[data]
    word = kind == WORD
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    # Texts lie next to each other without a separator.
    first[begins] = word[begins]
    last[begins[1:] - 1] = word[begins[1:] - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    held = data[word]
    codes, words = encode(binary_array(LOWER[held] if lower else held, lengths))
    # Texts and breaks are fewer than words: look these up among the words, not the other way round.
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    passed = np.searchsorted(starts, np.flatnonzero(kind == BREAK))
    piece = np.cumsum(np.bincount(passed, minlength=len(starts) + 1))[: len(starts)]
    return Words(doc, codes, words, piece)
