"""SentencePiece encoding and decoding through a table of distinct chunks.

The model's pieces never hold a white space marker behind another character, so no piece crosses the
place where a run of markers begins, and merges on both sides of it do not affect each other. A text
is cut there into marked words. A block of texts has far fewer distinct marked words than places:
each distinct one is segmented and decoded once, by the library, and its ids and text are put back
at all its places, by position, with one gather.

The table belongs to a Python worker and is emptied when it grows beyond ``WORDS_KEPT``. One table
for the whole corpus would send every place through a shuffle to save a segmentation that takes
microseconds.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.llm.words import binary_array, bounded, column_bytes, encode

MARK = "▁"
WORDS_KEPT = 600_000
# Longer ones, as in texts without spaces, are segmented anew at each of their blocks.
LONGEST_KEPT = 256
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ChunkTable:
    """Marked words of one model: the decimal ids of each, and its decoded text where it differs."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.vocab_size()
        if any(MARK in self.model.id_to_piece(i).lstrip(MARK) for i in range(size)):
            raise ValueError("pieces of this model cross white space; its texts cannot be cut there")
        if self.model.normalize("a  ﬁ\t") != f"{MARK}a{MARK}{MARK}ﬁ\t":
            raise ValueError("the model changes texts beyond marking spaces")
        self.decimals = [f"{i} ".encode() for i in range(size)]
        self.known: dict[bytes, bytes] = {}
        self.changed: dict[bytes, bytes] = {}

    def _segment(self, chunks: list[bytes]) -> None:
        # The library puts a marker before every text, which stands for the space cut off here.
        texts = [chunk.decode() for chunk in chunks]
        ids = self.model.encode(texts, num_threads=1)
        ids = [x if text else [self.model.piece_to_id(MARK)] for x, text in zip(ids, texts, strict=True)]
        decoded = self.model.decode(ids, num_threads=1) if ids else []
        for chunk, own, text, back in zip(chunks, ids, texts, decoded, strict=True):
            self.known[chunk] = b"".join(map(self.decimals.__getitem__, own))
            if back != text:
                self.changed[chunk] = back.encode()

    def __call__(self, chunks: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Decimal ids with a space behind each, and decoded texts without the marker's space."""
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
            self.changed.clear()
        missing = [chunk for chunk in chunks if chunk not in self.known]
        self._segment(missing)
        decimals = list(map(self.known.__getitem__, chunks))
        texts = [self.changed.get(chunk, chunk) for chunk in chunks] if self.changed else chunks
        for chunk in missing:
            if len(chunk) > LONGEST_KEPT:
                del self.known[chunk]
                self.changed.pop(chunk, None)
        return decimals, texts


def worker_table(model: bytes) -> ChunkTable:
    """One table per Python worker and model."""
    holder = sys.modules.setdefault("_worker_chunk_tables", ModuleType("_worker_chunk_tables"))
    key = zlib.crc32(model)
    if key not in vars(holder).setdefault("known", {}):
        holder.known[key] = ChunkTable(model)
    return holder.known[key]


def marked_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(text, codes, chunks)``: each text cut before every run of spaces.

    A chunk is a marked word without its first marker; the first of a text has the marker that the
    library adds, so nothing is cut off from it.
    """
    data, offsets = column_bytes(texts)
    space = data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    cut[begins] = False
    # A run that starts a text is not cut inside.
    after = np.zeros(len(data), bool)
    after[begins] = True
    starts = np.flatnonzero(cut | after)
    lengths = np.diff(np.append(starts, len(data))) - cut[starts]
    codes, chunks = encode(binary_array(data[~cut], lengths))
    return np.searchsorted(offsets[1:], starts, side="right"), codes, chunks


def _digests(parts: pa.Array, codes: np.ndarray, ends: np.ndarray, between: bytes, tail: bytes) -> list[str]:
    """SHA-256 per text of its parts in a row, each after ``between`` but the first, and ``tail``."""
    laid = parts.take(pa.array(codes))
    if between:
        laid = pc.binary_join_element_wise(pa.scalar(b"", laid.type), laid, pa.scalar(between, laid.type))
    data, offsets = column_bytes(laid)
    view, out = memoryview(data), []
    for start, end in zip(offsets[ends[:-1]], offsets[ends[1:]], strict=True):
        digest = hashlib.sha256(view[min(start + len(between), end) : end])
        digest.update(tail)
        out.append(digest.hexdigest())
    return out


def encode_block(table: ChunkTable, texts: pa.Array, end_id: int) -> tuple[np.ndarray, list[str], list[str]]:
    """``(n_tokens, ids_sha256, decoded_sha256)`` of these texts."""
    if pc.any(pc.match_substring(texts, MARK)).as_py():
        texts = pc.replace_substring(texts, MARK, " ")
    end = str(end_id).encode()
    doc, codes, chunks = marked_words(texts)
    if not len(codes):
        ids, decoded = hashlib.sha256(end).hexdigest(), hashlib.sha256(b"").hexdigest()
        return np.ones(len(texts), np.int64), [ids] * len(texts), [decoded] * len(texts)
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    decimals, decoded = (pa.array(x, pa.large_binary()) for x in table(chunks.to_pylist()))
    counts = pc.count_substring(decimals, b" ").to_numpy()
    upto = np.concatenate([[0], np.cumsum(counts[codes], dtype=np.int64)])
    return (
        upto[ends[1:]] - upto[ends[:-1]] + 1,
        _digests(decimals, codes, ends, b"", end),
        _digests(decoded, codes, ends, b" ", b""),
    )


def _encode(model: bytes, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(model)
        for batch in batches:
            for part in bounded(batch):
                n_tokens, ids, decoded = encode_block(table, part.column("text"), end_id)
                columns = [part.column("id"), pa.array(n_tokens), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_documents(
    docs: DataFrame, model: bytes, *, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of docs: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``model`` is the content of a SentencePiece file whose pieces do not cross white space and whose
    normaliser only marks it; others are refused. A NULL or empty text is the end id alone and
    decodes to an empty text. Rows that repeat an id each keep their result, a NULL id stays NULL;
    no rows, no result. Other columns are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(_encode(model, end_id), SCHEMA)
