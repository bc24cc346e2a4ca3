"""Pack tokenised documents into full sequences by minimum bin slack.

Each bin starts with the longest piece left. A subset-sum dynamic programme over the available
lengths, one bit per reachable fill, finds the fullest feasible combination, which is removed. Only
lengths matter, so the programme runs on the histogram of lengths (at most ``capacity`` numbers) and
each combination is used as often as its lengths last. Spark then deals pieces to places by their
rank among the pieces of one length.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundspark.llm.words import bounded, byte_kinds, column_bytes, split_words
from fundspark.operators.lineage import materialise

PIECES_KEPT = 1_000_000
PIECES_AT_ONCE = 2_000
# White space inside texts whose words are encoded one by one.
_SPACES = byte_kinds(b"\t\n\r ")
# Characters for which splitting at white space first cannot change the tokens: composed Latin
# letters and ASCII. Texts with other ones go to the tokenizer whole.
_OTHER = re.compile("[^!-~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]")
# What the tokenizer makes pieces of within a word of such characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
WORD_END = "</w>"
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of whole texts; a word is encoded once and remembered.

    Only for a tokenizer that drops white space and lower-cases, whose pieces never cross a white
    space and end in a token of their own kind; any other one gets all texts whole.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        layout = json.loads(tokenizer_json)
        normalizer = layout.get("normalizer") or {}
        steps = {x.get("type") for x in normalizer.get("normalizers", [normalizer])}
        splits = str((layout.get("pre_tokenizer") or {}).get("pretokenizers", ""))
        suffix = layout["model"].get("end_of_word_suffix") == WORD_END
        self.by_word = suffix and {"Replace", "Lowercase"} <= steps and "[^\\\\s\\\\p{L}\\\\p{N}]+" in splits
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith(WORD_END)]] = True
        self.pieces: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Many pieces go to the tokenizer as one text; tokens that end a piece tell them apart."""
        for start in range(0, len(pieces), PIECES_AT_ONCE):
            part = pieces[start : start + PIECES_AT_ONCE]
            found = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            if len(cuts) == len(part) + 1 and cuts[-1] == 4 * len(ids):
                laid = ids.tobytes()
                self.pieces.update(zip(part, map(laid.__getitem__, map(slice, cuts, cuts[1:])), strict=False))
            else:
                self.pieces.update((piece, self.whole(piece)) for piece in part)

    def _ids_of(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of words; None where a text must go to the tokenizer whole."""
        split: list[list[str] | None] = []
        for word in words:
            text = word.decode()
            if text.isascii() and text.isalpha():
                split.append([text])
            elif _OTHER.search(text) or "<|" in text:
                split.append(None)
            else:
                split.append(_PIECE.findall(text.lower()))
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.clear()
        known = self.pieces
        self._learn(list({x for parts in split if parts for x in parts if x not in known}))
        return [
            None if parts is None else known[parts[0]] if len(parts) == 1 else b"".join(map(known.__getitem__, parts))
            for parts in split
        ]

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
        """``(bytes, ends, whole)``: little-endian ids of all texts in a row, where each text's begin
        and end, and the ids of texts that were not encoded by words."""
        if not self.by_word:
            whole = {i: self.whole(x) for i, x in enumerate(texts.to_pylist())}
            return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64), whole
        found = split_words(texts, _SPACES)
        ids = pa.array(self._ids_of(found.words.to_pylist()), pa.large_binary())
        unknown = ids.is_null().to_numpy(zero_copy_only=False)
        whole = {}
        if unknown.any():
            for i in np.unique(found.doc[unknown[found.codes]]).tolist():
                whole[i] = self.whole(texts[i].as_py())
        laid = ids.fill_null(b"").take(pa.array(found.codes))
        data, offsets = column_bytes(laid)
        return data, offsets[np.searchsorted(found.doc, np.arange(len(texts) + 1))], whole

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        data, ends, whole = self.block(pa.array([x or "" for x in texts], pa.string()))
        for i in range(len(texts)):
            yield whole[i] if i in whole else data[ends[i] : ends[i + 1]].tobytes()


def worker_encoder(tokenizer_json: str) -> Encoder:
    """One encoder per Python worker: it serves many tasks and keeps what it has learned."""
    holder = sys.modules.setdefault("_worker_encoders", ModuleType("_worker_encoders"))
    key = zlib.crc32(tokenizer_json.encode())
    if key not in vars(holder).setdefault("known", {}):
        holder.known[key] = Encoder(tokenizer_json)
    return holder.known[key]


def _pieces(tokenizer_json: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = worker_encoder(tokenizer_json), np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            for part in bounded(batch):
                data, ends, whole = encode.block(part.column("text"))
                laid = memoryview(data)
                row, piece, start, length, crc = [], [], [], [], []
                for i, (low, high) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                    ids = whole[i] + end if i in whole else laid[low:high]
                    if i not in whole and (high - low) + 4 <= step:
                        # Nearly all texts are one piece.
                        found = [(0, (high - low) // 4 + 1, zlib.crc32(end, zlib.crc32(ids)))]
                    else:
                        ids = bytes(ids) if i in whole else bytes(ids) + end
                        cuts = [ids[at : at + step] for at in range(0, len(ids), step)]
                        found = [(n * capacity, len(x) // 4, zlib.crc32(x)) for n, x in enumerate(cuts)]
                    for n, (at, size, checksum) in enumerate(found):
                        row.append(i)
                        piece.append(n)
                        start.append(at)
                        length.append(size)
                        crc.append(checksum)
                columns = [
                    part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def tokenised_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document's ids and ``end_id``, cut only where it is longer than ``capacity``."""
    tokenizer_json = Path(tokenizer_path).read_text(encoding="utf-8")
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(_pieces(tokenizer_json, capacity, end_id), PIECE_SCHEMA)


def fullest(lengths: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The combination with the least slack that holds the longest length: ``(length, times)``.

    Bit s of ``reach`` says that s more tokens can be filled exactly. Long lengths come first, so
    ties go to the combination with the longer pieces and short ones stay to fill later bins.
    """
    longest = max(lengths)
    room = capacity - longest
    reach, full, items = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in lengths if x <= room), reverse=True):
        left = min(lengths[length] - (length == longest), room // length)
        times = 1
        while left > 0:
            times = min(times, left)
            items.append((length, times, reach))
            reach |= (reach << (length * times)) & full
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    fill = reach.bit_length() - 1
    chosen = {longest: 1}
    for length, times, before in reversed(items):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + times
            fill -= length * times
    return sorted(chosen.items(), reverse=True)


def plan_bins(lengths: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """``(combination, number of bins)`` until no piece is left."""
    left = {length: count for length, count in lengths.items() if count}
    plan = []
    while left:
        chosen = fullest(left, capacity)
        bins = min(left[length] // times for length, times in chosen)
        plan.append((chosen, bins))
        for length, times in chosen:
            left[length] -= times * bins
            if not left[length]:
                del left[length]
    return plan


def _places(plan) -> list[tuple[int, int, int, int, int, list[int]]]:
    """Per combination and length: the ranks it takes, and where they go."""
    rows, taken, sequence = [], {}, 0
    for chosen, bins in plan:
        offset = 0
        for length, times in chosen:
            first = taken.get(length, 0)
            taken[length] = first + times * bins
            offsets = [offset + i * length for i in range(times)]
            rows.append((length, first, taken[length], times, sequence, offsets))
            offset += times * length
        sequence += bins
    return rows


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_rows: int = 100_000,
) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A NULL or empty text is the end id alone. Rows that repeat an id are packed each on its own.
    A NULL id stays NULL. Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    pieces = tokenised_pieces(
        docs, tokenizer_path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col
    )
    pieces = materialise(pieces, "pack-pieces")
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    lengths = {row["length"]: row["count"] for row in counted}
    rows = _places(plan_bins(lengths, capacity))
    places = spark.createDataFrame(
        rows, "length long, low long, high long, times long, sequence long, offsets array<long>"
    )
    # Ranks in two steps, so that the pieces of one length need not meet in one task.
    parts = max(1, -(-sum(lengths.values()) // part_rows))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int")
    pieces = pieces.withColumn("part", spread)
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base"))
    # Bounded by the number of combinations, each of which uses up a length.
    placed = ranked.join(F.broadcast(places), "length").where("rank >= low and rank < high")
    step = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(step / F.col("times"))).alias("sequence_id"),
        F.col("offsets")[(step % F.col("times")).cast("int")].alias("offset"),
    )
