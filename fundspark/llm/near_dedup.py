"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join.

A document's set of word shingles gets a signature of ``chunks * width`` MinHash symbols of 16
bits. Two signatures that differ in at most ``2 * chunks - 1`` symbols have, by pigeonhole, a chunk
with at most one differing symbol. Each chunk is therefore indexed once per position with that
position left out: the allowed errors are enumerated, and every pair within that distance shares
an index key. Pairs beyond it that share a key are looked at as well, so a pair at similarity 0.8
is missed only if none of its chunks has at most one differing symbol: a chance of about 1e-7.
Candidates are weighed by an upper bound of what they share, which loses no link, and confirmed on
the full sets.

Buckets are never expanded into all pairs. Documents with equal sets are one node. A bucket first
compares its best connected member, the centre, with all others; once components are known, only
members outside the centre's component still meet members of other components. Links inside a
component would not change it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.llm.batches import bounded_batches
from fundspark.llm.components import components
from fundspark.operators.lineage import materialise

CHUNKS, WIDTH = 12, 5
# Shingles are counted in so many bins, up to FULL a bin. Two sets share at most the smaller count of
# every bin; where both are FULL they may share anything.
BINS, FULL = 256, 255
BLOCK = 512
GROUP_ROWS = 20_000
WORDS_KEPT = 500_000


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than ``size`` are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    count = len(words) - span + 1
    value = np.full(count, span, np.uint64)
    for i in range(span):
        value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + count])
    return np.unique(value)


def least_hashes(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest of the shingles' hashes under each hash function."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        block = shingles[None, start : start + 4096] * multipliers[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return mix64(least)


def _multipliers(count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, count])
    return rng.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def _sketch(size: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        multipliers = _multipliers(CHUNKS * WIDTH, seed)
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch["text"]:
                found = shingle_set(text, size, hashes)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                symbols = least_hashes(found, multipliers).astype("<u2").tobytes()
                signatures.append(symbols if len(found) else None)
            yield pd.DataFrame(
                {"id": batch["id"], "n": sizes, "set_key": keys, "signature": signatures}
            )

    return run


def _index_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One key per chunk and left-out position: the other four symbols, exactly, in 64 bits."""
    kept = np.array([[p for p in range(WIDTH) if p != out] for out in range(WIDTH)])
    tag = mix64(np.arange(1, CHUNKS * WIDTH + 1, dtype=np.uint64)).reshape(CHUNKS, WIDTH)
    for batch in batches:
        if not len(batch):
            continue
        raw = np.frombuffer(b"".join(batch["signature"]), "<u2").astype(np.uint64)
        symbols = raw.reshape(len(batch), CHUNKS, WIDTH)[:, :, kept]
        value = np.zeros(symbols.shape[:3], np.uint64)
        for i in range(WIDTH - 1):
            value = (value << np.uint64(16)) | symbols[..., i]
        keys = mix64(value ^ tag).reshape(len(batch), -1).view(np.int64)
        slots = np.tile(np.arange(CHUNKS * WIDTH, dtype=np.int32), len(batch))
        ids = np.repeat(batch["id"].to_numpy(), CHUNKS * WIDTH)
        yield pd.DataFrame({"key": keys.ravel(), "slot": slots, "id": ids})


def bin_counts(shingles: np.ndarray) -> np.ndarray:
    counts = np.bincount((shingles % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, FULL).astype(np.uint8)


def can_link(sizes_a, bins_a, sizes_b, bins_b, percent: int) -> np.ndarray:
    """Whether pairs may be similar enough: False only where their full sets cannot be."""
    least, most = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    smaller = np.minimum(bins_a, bins_b)
    both = np.where((smaller == FULL).any(axis=1), least, smaller.sum(axis=1, dtype=np.int64))
    return (100 * least >= percent * most) & ((100 + percent) * both >= percent * (least + most))


def _profile(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(text, size, hashes) for text in batch["text"]]
            bins = [bin_counts(x).tobytes() for x in sets]
            yield pd.DataFrame(
                {"id": batch["id"], "n": [len(x) for x in sets], "bins": bins, "shingles": [x.tobytes() for x in sets]}
            )

    return run


def _bytes(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _weigh(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bins = _bytes(batch["bins_a"], "u1"), _bytes(batch["bins_b"], "u1")
                sizes = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
                yield batch.loc[can_link(sizes[0], bins[0], sizes[1], bins[1], percent), ["a", "b"]]

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for one, two in zip(batch["xa"], batch["xb"], strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    return run


def _linked(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. ``pairs`` (a, b) are distinct."""
    for side in ("b", "a"):
        sets = profiles.select(F.col("id").alias(side), F.col("shingles").alias(f"x{side}"))
        pairs = pairs.join(sets, side)
    return materialise(pairs.mapInPandas(_confirm(percent), "a long, b long"), "near-links")


def _block_pairs(percent: int):
    """Pairs of one block of a bucket that the counts of their shingles allow.

    Two documents can share several buckets. Only the bucket of their first common key reports
    the pair.
    """
    def cell(slot: int, outer: pd.DataFrame, inner: pd.DataFrame) -> Iterator[pd.DataFrame]:
        left, right = _bytes(outer["signature"], "<u2"), _bytes(inner["signature"], "<u2")
        bins_left, bins_right = _bytes(outer["bins"], "u1"), _bytes(inner["bins"], "u1")
        sizes_left, sizes_right = outer["n"].to_numpy(), inner["n"].to_numpy()
        ids, roots = inner["id"].to_numpy(), inner["root"].to_numpy()
        for at, (a, root) in enumerate(zip(outer["id"], outer["root"], strict=True)):
            differ = (right != left[at]).reshape(-1, CHUNKS, WIDTH)
            errors = differ.sum(axis=2)
            first = (errors <= 1).argmax(axis=1)
            place = differ[np.arange(len(right)), first].argmax(axis=1)
            own = np.flatnonzero((first * WIDTH + place == slot) & (roots != root))
            own = own[can_link(sizes_left[at], bins_left[at], sizes_right[own], bins_right[own], percent)]
            if len(own):
                b = ids[own]
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})]
        for (_, slot, _, _), block in rows.groupby(["key", "slot", "block_a", "block_b"]):
            found += cell(slot, block[block["outer"]], block[~block["outer"]])
        return pd.concat(found)

    return run


def _rest(members, centres, roots, nodes, profiles, percent: int) -> DataFrame:
    """Candidate pairs between components, from buckets that hold more than one.

    One of the two lies outside the component of the bucket's centre. Buckets are cut into cells
    of about ``BLOCK`` such members and ``BLOCK`` members. Cells are dealt to groups by the rows
    they hold together, so a task holds about ``GROUP_ROWS`` rows however large a bucket is.
    """

    def rooted(rows: DataFrame, column: str, name: str) -> DataFrame:
        known = roots.select(F.col("node").alias(column), F.col("root").alias(name))
        known = rows.join(known, column, "left")
        return known.withColumn(name, F.coalesce(name, column))

    placed = rooted(members.select("key", "slot", "id", "size"), "id", "root")
    placed = placed.join(rooted(centres, "centre", "centre_root"), "key")
    placed = placed.withColumn("outer", F.col("root") != F.col("centre_root"))
    placed = materialise(placed.select("key", "slot", "id", "size", "root", "outer"), "near-placed")
    active = placed.where("outer").groupBy("key").agg(
        F.count(F.lit(1)).alias("outside"), F.first("size").alias("all")
    )
    small = nodes.join(profiles.select("id", "n", "bins"), "id").dropDuplicates(["id"])
    rows = placed.join(active.drop("all"), "key").join(small, "id")

    def blocks(count: str):
        return F.ceil(F.col(count) / BLOCK).cast("int")

    def own(count: str):
        return F.pmod(F.xxhash64("id"), blocks(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), blocks(count) - 1))

    layout = ["key", "slot", "id", "root", "n", "signature", "bins", "outer", "block_a", "block_b"]
    outer = rows.where("outer").withColumn("block_a", own("outside")).withColumn("block_b", every("size"))
    inner = rows.withColumn("outer", F.lit(False)).withColumn("block_b", own("size"))
    inner = inner.withColumn("block_a", every("outside"))
    cells = outer.select(*layout).union(inner.select(*layout))
    # The rows of all cells: either side is sent once per block of the other.
    sent = F.col("outside") * blocks("all") + F.col("all") * blocks("outside")
    groups = max(1, -(-(active.agg(F.sum(sent)).first()[0] or 0) // GROUP_ROWS))
    spread = F.pmod(F.xxhash64("key", "block_a", "block_b"), F.lit(groups)).alias("group")
    pairs = cells.groupBy(spread).applyInPandas(_block_pairs(percent), "a long, b long")
    return materialise(pairs.distinct(), "near-rest")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    seed: int = 7,
) -> DataFrame:
    """Per row of docs: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of characters other than ASCII white space, A-Z in lower case. Two documents
    are linked when ``100 * |A & B| >= percent * |A | B|``; ``component_id`` is the smallest id
    reachable over links, ``kept`` tells whether it is the document's own.

    A NULL or blank text has no shingles and is linked with nothing. A row without an id belongs
    to no component and is kept (``component_id`` NULL). Rows that repeat an id are one document:
    it has one component, taking the links of all its texts. Other columns are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    # Every Python step is written inside; what is returned only joins written tables.
    with bounded_batches(docs.sparkSession):
        return _components_of(texts, shingle_words, percent, seed)


def _components_of(texts: DataFrame, shingle_words: int, percent: int, seed: int) -> DataFrame:
    schema = "id long, n long, set_key binary, signature binary"
    sketches = materialise(texts.mapInPandas(_sketch(shingle_words, seed), schema), "near-sketch")
    known = sketches.where("id is not null and n > 0")
    # Documents with equal sets are one node, named by its smallest id.
    nodes = known.groupBy("set_key").agg(
        F.min("id").alias("id"), F.first("signature").alias("signature")
    )
    nodes = materialise(nodes.select("set_key", "id", "signature"), "near-nodes")
    copies = known.join(nodes.select("set_key", F.col("id").alias("a")), "set_key")
    copies = copies.where("id <> a").select("a", F.col("id").alias("b"))
    # An id whose rows hold several texts can name several nodes; any signature of it will do
    # for the index, and all its texts are linked through the id itself.
    nodes = nodes.select("id", "signature")

    keys = nodes.mapInPandas(_index_keys, "key long, slot int, id long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(keys.join(shared, "key"), "near-members")
    wanted = members.select("id").distinct()
    profiles = texts.join(wanted, "id", "left_semi").mapInPandas(
        _profile(shingle_words), "id long, n long, bins binary, shingles binary"
    )
    profiles = materialise(profiles, "near-profiles")
    # The centre of a bucket is the member that meets most others over all its keys.
    reach = members.groupBy("id").agg(F.sum("size").alias("reach"))
    ranked = members.join(reach, "id").groupBy("key").agg(
        F.max(F.struct("reach", (-F.col("id")).alias("order"))).alias("best")
    )
    centres = materialise(ranked.select("key", (-F.col("best.order")).alias("centre")), "near-centres")
    stars = members.join(centres, "key").where("id <> centre")
    stars = stars.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    for side in ("b", "a"):
        counts = profiles.select(
            F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bins").alias(f"bins_{side}")
        )
        stars = stars.join(counts, side)
    stars = materialise(stars.mapInPandas(_weigh(percent), "a long, b long").distinct(), "near-stars")
    links = _linked(stars, profiles, percent)
    more = _linked(
        _rest(members, centres, components(links), nodes, profiles, percent), profiles, percent
    )

    roots = components(links.union(more).union(copies))
    result = sketches.select("id", "n").join(
        roots.select(F.col("node").alias("id"), "root"), "id", "left"
    )
    component = F.coalesce("root", "id")
    return result.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
