"""Ranked lexical search by dense blocked matrix products.

Items are dealt to tiles, each with a compact vocabulary of its own. A block of documents becomes a
dense matrix of the impacts of these terms, the tile one of their weights, and one BLAS product
gives all scores of the block. Impacts and weights are whole numbers; columns are cut into panels
whose sums stay below 2**53, so products in double precision are exact, and panels are added as
integers. Of every block an item keeps the k best rows, equal scores by id, which no later block can
displace wrongly; Spark merges them over all tasks.

Texts are read once per pass of items (all items, unless they are very many): a pass leaves the
counts of its vocabulary per document, from which document frequencies and lengths are summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundspark.llm.words import bounded, byte_kinds, split_words
from fundspark.operators.lineage import materialise

# Bytes that are no part of a term.
BETWEEN = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
KINDS = byte_kinds(BETWEEN)
EXACT = 2**53
MOST_IMPACT = 1_000_000
ITEMS_IN_TILE, ROWS_IN_BLOCK, TERMS_IN_PANEL = 32, 2_048, 1_024
# Characters of items whose vocabulary a pass holds in memory.
PASS_CHARS = 16 << 20
COUNTED = "id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"


@dataclass
class Items:
    """Items of one pass: keys, and per item the counts of its terms, by number in ``vocabulary``."""

    keys: list
    vocabulary: dict[bytes, int]
    terms: list[dict[int, int]]


def collect_items(items: DataFrame) -> Items:
    """Rows that repeat a key are one item; equal texts count once."""
    rows = items.distinct().collect()
    found = split_words(pa.array([row["text"] for row in rows], pa.string()), KINDS)
    words = found.words.to_pylist()
    keys: dict = {}
    terms: list[dict[int, int]] = []
    for row in rows:
        if keys.setdefault(row["item"], len(keys)) == len(terms):
            terms.append(Counter())
    for doc, code in zip(found.doc, found.codes, strict=True):
        terms[keys[rows[doc]["item"]]][int(code)] += 1
    return Items(list(keys), {word: i for i, word in enumerate(words)}, terms)


def _count(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for part in bounded(batch):
                found = split_words(part.column("text"), KINDS)
                lengths = np.bincount(found.doc, minlength=part.num_rows)
                number = np.array([known.get(w, -1) for w in found.words.to_pylist()], np.int64)
                term = number[found.codes] if len(number) else found.codes
                held = term >= 0
                place, tf = np.unique(found.doc[held] * len(known) + term[held], return_counts=True)
                doc, term = np.divmod(place, max(len(known), 1))
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                columns = [
                    part.column("id"),
                    pa.array(lengths.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, term.astype(np.int32)),
                    pa.ListArray.from_arrays(ends, tf.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    return run


@dataclass
class Tile:
    """Some items and their panels: ``(terms, weights)``, weights with a column per item."""

    items: np.ndarray
    panels: list[tuple[np.ndarray, np.ndarray]]


def panels_of(weighted: list[dict[int, int]], most_terms: int = TERMS_IN_PANEL) -> list[tuple[np.ndarray, np.ndarray]]:
    """Cut the terms of these items so that no sum of weight times impact reaches 2**53.

    A weight that is too large alone is split over several columns of its term.
    """
    most = (EXACT - 1) // MOST_IMPACT
    panels, columns, sums = [], [], np.zeros(len(weighted), object)

    def close() -> None:
        if columns:
            terms, weights = zip(*columns, strict=True)
            panels.append((np.array(terms), np.array(weights, np.float64)))
            columns.clear()
            sums[:] = 0

    for term in sorted(set().union(*weighted)):
        left = [own.get(term, 0) for own in weighted]
        while any(left):
            now = [min(w, most) for w in left]
            if len(columns) >= most_terms or any(s + w > most for s, w in zip(sums, now, strict=True)):
                close()
            columns.append((term, now))
            sums += np.array(now, object)
            left = [w - part for w, part in zip(left, now, strict=True)]
    close()
    return panels


def make_tiles(items: Items, weight: dict[int, int]) -> list[Tile]:
    tiles = []
    for start in range(0, len(items.keys), ITEMS_IN_TILE):
        numbers = range(start, min(start + ITEMS_IN_TILE, len(items.keys)))
        weighted = [
            {t: weight[t] * times for t, times in items.terms[i].items() if weight.get(t, 0) > 0}
            for i in numbers
        ]
        tiles.append(Tile(np.array(numbers), panels_of(weighted)))
    return tiles


class Best:
    """The k best rows of one item so far; equal scores by smaller id, a missing id first."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) > 4 * self.k:
            kept = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[kept], ids[kept]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


NO_ID = np.iinfo(np.int64).min


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass
class Block:
    """Impacts of some documents, sorted by term."""

    rows: int
    term: np.ndarray
    row: np.ndarray
    impact: np.ndarray

    @classmethod
    def of(cls, rows: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> Block:
        order = np.argsort(term, kind="stable")
        return cls(rows, term[order], row[order], impact[order])

    def dense(self, terms: np.ndarray) -> np.ndarray:
        """A column per term, in this order."""
        low = np.searchsorted(self.term, terms, side="left")
        many = np.searchsorted(self.term, terms, side="right") - low
        column = np.repeat(np.arange(len(terms)), many)
        at = np.arange(len(column)) + np.repeat(low - (np.cumsum(many) - many), many)
        out = np.zeros((self.rows, len(terms)))
        out[self.row[at], column] = self.impact[at]
        return out


def block_scores(tile: Tile, block: Block) -> np.ndarray:
    """Exact scores of the documents of a block for the items of a tile."""
    total = np.zeros((block.rows, len(tile.items)), np.int64)
    for terms, weights in tile.panels:
        total += (block.dense(terms) @ weights).astype(np.int64)
    return total


def _rank(shared, documents: int, terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        best = {int(i): Best(k) for tile in tiles for i in tile.items}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_IN_BLOCK):
                part = batch.slice(start, ROWS_IN_BLOCK)
                ids = part.column("id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
                n = part.column("n").to_numpy(zero_copy_only=False)
                m = 100 - 75 + (75 * n * documents) // terms
                held = part.column("terms")
                term = held.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
                block = Block.of(part.num_rows, row, term, impacts(tf, m[row]))
                for tile in tiles:
                    scores = block_scores(tile, block)
                    # Equal scores still count: their ids decide.
                    least = np.array([best[int(i)].least for i in tile.items])
                    at, column = np.nonzero(scores >= least)
                    for c in np.unique(column):
                        rows = at[column == c]
                        best[int(tile.items[c])].add(scores[rows, c], ids[rows])
        out = [(item, i, s) for item, b in best.items() for i, s in zip(b.ids, b.scores, strict=True)]
        item, doc_id, score = map(list, zip(*out, strict=True)) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item, pa.int32()),
                pa.array([None if i == NO_ID else int(i) for i in doc_id], pa.int64()),
                pa.array(score, pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return run


def term_weights(frequencies: dict[int, int], documents: int) -> dict[int, int]:
    return {
        term: int(np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))))
        for term, df in frequencies.items()
    }


def _rank_pass(texts: DataFrame, items: Items, k: int) -> DataFrame:
    """``item, doc_id, score``: the k best documents of each of these items, per task."""
    spark = texts.sparkSession
    vocabulary = spark.sparkContext.broadcast(items.vocabulary)
    counted = materialise(texts.mapInArrow(_count(vocabulary), COUNTED), "lexical-counts")
    held = counted.where("n > 0").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("l")).first()
    if not held["d"]:
        return spark.createDataFrame([], "item int, doc_id long, score long")
    # At most a row per term of these items.
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = term_weights({row["term"]: row["count"] for row in df}, held["d"])
    tiles = spark.sparkContext.broadcast(make_tiles(items, weight))
    matched = counted.where(F.size("terms") > 0)
    return matched.mapInArrow(_rank(tiles, held["d"], held["l"], k), FOUND)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    pass_chars: int = PASS_CHARS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores above 0 per item.

    Equal scores go by ascending id, a NULL id first. A NULL or empty text has no term and counts
    neither as a document nor for an item. Rows of docs that repeat an id are documents of their
    own. Rows that repeat an item id are one item with the terms of all their different texts. No
    documents with a term, or no items: an empty result. Other columns are not read.

    Items beyond ``pass_chars`` characters are dealt to several passes by a hash of their id, so
    what a task holds in memory does not grow with the number of items.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    asked = items.select(
        F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text")
    )
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-chars // pass_chars))
    kind = asked.schema["item"].dataType.simpleString()
    results = []
    for number in range(passes):
        of_pass = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number) if passes > 1 else asked
        own = collect_items(of_pass)
        names = spark.createDataFrame(list(enumerate(own.keys)), f"item int, item_id {kind}")
        ranked = _rank_pass(texts, own, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        results.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionAll, results)
