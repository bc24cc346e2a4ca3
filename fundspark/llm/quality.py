"""Document quality by Bradley-Terry pairwise ranking.

A document's worth is a linear function of text statistics and of the words it uses: shares of its
words and of its neighbouring words, hashed to ``GRAM_BUCKETS``. It is learned from preference pairs, a
document labelled 1 over one labelled 0: the chance that the first wins is the logistic function
of the difference of their worths, so the loss is logistic on feature differences. Every labelled
document outside the held-out fold and every pair of them counts. Documents are then cut by a
quantile of the learned worth: the share of label 0 among the training documents.

The pairs are never listed. What a document meets of all documents of the other label is a smooth
function of its worth, so both sides are summed on the Chebyshev nodes of narrow panels of worth, and
the logistic function is taken between nodes: that equals the sum over all pairs to about 1e-12.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise

FEATURES = (
    "log_words upper symbol mark bar digit space newline wide word_length word_spread "
    "unique repeat run decorated trailing_bar top_word top_byte lines line_copies stops"
).split()
# Hashed words and pairs of words, behind the statistics.
GRAM_BUCKETS = 64
WIDTH = len(FEATURES) + GRAM_BUCKETS
_DECORATED = re.compile(rb"[^\w\s.,;:'\"()\-\x80-\xff]+(?=\s|$)")
_CLASSES = np.zeros((7, 256))
for _row, _members in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*+<=>@^_~\\", b"!?", b"|", b"0123456789", b" \t", b"\n")
):
    _CLASSES[_row, list(_members)] = 1


def text_statistics(text: str | None) -> np.ndarray:
    """``FEATURES`` of one whole text, then its word buckets; zeros for a NULL or blank one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(WIDTH)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    shares = _CLASSES @ counts / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    repeats = sum(map(bytes.__eq__, words[1:], words[:-1]))
    lines = [line for line in raw.split(b"\n") if line]
    solid = counts.copy()
    solid[32] = 0
    statistics = np.array(
        [
            np.log1p(n),
            *shares,
            counts[128:].sum() / size,
            lengths.mean() / 10,
            min(lengths.std() / 10, 5.0),
            len(seen) / n,
            repeats / n,
            min(1.0, repeats / 3),
            len(_DECORATED.findall(raw)) / n,
            raw.count(b" | ") / n,
            max(seen.values()) / n if n > 5 else 0.0,
            solid.max() / size,
            np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines),
            sum(word.endswith(b".") for word in words) / n,
        ]
    )
    return np.concatenate([statistics, word_buckets(words, seen)])


def word_buckets(words: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    """Shares of words and of pairs of neighbouring words per bucket; case does not count."""
    codes = {word: zlib.crc32(word.lower()) for word in seen}
    code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    pairs = (code[:-1] * np.uint64(0x9E3779B1) + code[1:]) >> np.uint64(7)
    found = np.concatenate([code, pairs]) % np.uint64(GRAM_BUCKETS)
    return np.bincount(found.astype(np.int64), minlength=GRAM_BUCKETS) / len(words)


# Worths of a panel lie within PANEL of each other.
PANEL, NODES = 2.0, 16
_ANGLES = (np.arange(NODES) + 0.5) * np.pi / NODES
# From Chebyshev polynomials to the polynomials that are 1 on one node and 0 on the others.
_TO_NODES = np.cos(np.outer(np.arange(NODES), _ANGLES)) * 2 / NODES
_TO_NODES[0] /= 2
DIGIT_BITS = 11

# Runs a function of (features, label) over all blocks of the training rows and adds up what it returns.
Over = Callable[[Callable], object]


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def worth(self, features: np.ndarray) -> np.ndarray:
        # Summed row by row: a matrix product rounds a row by its place in the block.
        return (_scaled(features, self.centre, self.scale) * self.weights).sum(axis=1)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Worth on the scale 0 to 1, with the cutting quantile at ``threshold``."""
        offset = np.log(self.threshold / (1 - self.threshold))
        z = self.slope * (self.worth(features) - self.cut) + offset
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _scaled(features: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((features - centre) / scale, -8, 8)


def _added(one, two):
    """Sums of arrays, also inside tuples and dictionaries; a missing key counts as zero."""
    if isinstance(one, dict):
        both = dict(one)
        for key, value in two.items():
            both[key] = both[key] + value if key in both else value
        return both
    if isinstance(one, tuple):
        return tuple(map(_added, one, two))
    return one + two


def _panels(worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The panel of each worth, and the share of each of its nodes."""
    panel = np.floor(worth / PANEL).astype(np.int64)
    inside = np.clip(2 * (worth / PANEL - panel) - 1, -1, 1)
    return panel, np.cos(np.outer(np.arccos(inside), np.arange(NODES))) @ _TO_NODES


def _on_nodes(centre: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    """Per label and panel: documents and their features, summed on the panel's nodes."""

    def run(features: np.ndarray, label: np.ndarray) -> dict:
        rows = _scaled(features, centre, scale)
        panel, share = _panels(rows @ weights)
        rows = np.column_stack([np.ones(len(rows)), rows])
        found = {}
        for side, at in set(zip(label.tolist(), panel.tolist(), strict=True)):
            mine = (label == side) & (panel == at)
            found[side, at] = share[mine].T @ rows[mine]
        return found

    return run


def _second_moments(
    centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, force: dict[tuple[int, int], np.ndarray]
):
    """Products of features, each document times the force that ``force`` has on its panel's nodes."""

    def run(features: np.ndarray, label: np.ndarray) -> np.ndarray:
        rows = _scaled(features, centre, scale)
        panel, share = _panels(rows @ weights)
        pull = [force[key] for key in zip(label.tolist(), panel.tolist(), strict=True)]
        pull = (share * np.array(pull).reshape(share.shape)).sum(axis=1)
        return rows.T @ (rows * pull[:, None])

    return run


@dataclass(frozen=True)
class _Pairs:
    """The loss of all pairs at some weights, its slope, and what its curvature needs."""

    loss: float
    slope: np.ndarray
    crossed: np.ndarray
    force: dict[tuple[int, int], np.ndarray]


def _all_pairs(sums: dict, weights: np.ndarray, penalty: float) -> _Pairs:
    def side(label):
        keys = sorted(key for key in sums if key[0] == label)
        offset = (1 + np.cos(_ANGLES)) / 2
        at = np.concatenate([PANEL * (panel + offset) for _, panel in keys])
        rows = np.concatenate([sums[key] for key in keys])
        return keys, at, rows[:, 0], rows[:, 1:]

    (won, at_won, n_won, x_won), (lost, at_lost, n_lost, x_lost) = side(1), side(0)
    pairs = n_won.sum() * n_lost.sum()
    ahead = at_won[:, None] - at_lost[None, :]
    chance = np.exp(-np.logaddexp(0, ahead))
    loss = n_won @ np.logaddexp(0, -ahead) @ n_lost / pairs + penalty / 2 * weights @ weights
    slope = ((chance.T @ n_won) @ x_lost - (chance @ n_lost) @ x_won) / pairs + penalty * weights
    bend = chance * (1 - chance)
    force = {}
    for keys, values in ((won, bend @ n_lost), (lost, bend.T @ n_won)):
        force.update(zip(keys, values.reshape(len(keys), NODES) / pairs, strict=True))
    return _Pairs(float(loss), slope, x_won.T @ bend @ x_lost / pairs, force)


def _least_loss(over: Over, centre: np.ndarray, scale: np.ndarray, penalty: float) -> np.ndarray:
    """Newton's method with step halving, until a full step would gain less than 1e-13."""
    weights = np.zeros(len(centre))
    now = _all_pairs(over(_on_nodes(centre, scale, weights)), weights, penalty)
    while True:
        bend = over(_second_moments(centre, scale, weights, now.force))
        bend = bend - now.crossed - now.crossed.T + penalty * np.eye(len(weights))
        step = -np.linalg.solve(bend, now.slope)
        gain, length = -(now.slope @ step), 1.0
        if gain < 2e-13:
            return weights
        while True:
            further = weights + length * step
            after = _all_pairs(over(_on_nodes(centre, scale, further)), further, penalty)
            if after.loss <= now.loss - 1e-4 * length * gain:
                break
            length /= 2
            if length < 1e-6:
                return weights
        weights, now = further, after


def _ordered_bits(worth: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the worths."""
    bits = (worth + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) | np.int64(-(2**63)))).view(np.uint64)


def _digits(model: QualityModel, found: list[tuple[int | None, int]], shift: int, bits: int):
    """Per entry of ``found``, a label or None and the leading bits: rows by their next bits."""

    def run(features: np.ndarray, label: np.ndarray) -> np.ndarray:
        keys = _ordered_bits(model.worth(features))
        counts = np.zeros((len(found), 1 << bits), np.int64)
        for row, (side, lead) in enumerate(found):
            mine = np.ones(len(keys), bool) if side is None else label == side
            if shift + bits < 64:
                mine = mine & (keys >> np.uint64(shift + bits) == np.uint64(lead))
            digit = (keys[mine] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            counts[row] = np.bincount(digit.astype(np.int64), minlength=1 << bits)
        return counts

    return run


def _in_order(over: Over, model: QualityModel, places: list[tuple[int | None, int]]) -> np.ndarray:
    """The worths at these places, label (None: any) and number from 0, of all rows in order.

    Exact: every pass over the rows settles the next bits of all of them.
    """
    found, left, shift = [(side, 0) for side, _ in places], [at for _, at in places], 64
    while shift:
        bits = min(DIGIT_BITS, shift)
        shift -= bits
        before = np.cumsum(over(_digits(model, found, shift, bits)), axis=1)
        for row, (side, lead) in enumerate(found):
            digit = min(int(np.searchsorted(before[row], left[row], "right")), (1 << bits) - 1)
            left[row] -= int(before[row, digit - 1]) if digit else 0
            found[row] = (side, (lead << bits) | digit)
    keys = np.array([lead for _, lead in found], np.uint64).view(np.int64)
    return (keys ^ (~(keys >> 63) | np.int64(-(2**63)))).view(np.float64)


def _fit(over: Over, width: int, threshold: float, penalty: float) -> QualityModel:
    count = over(lambda x, label: np.array([(label == 0).sum(), (label == 1).sum()]))
    bad, good = map(int, count)
    if not good or not bad:
        flat = np.zeros(width)
        cut = 0.0 if good or not bad else 1e-9
        return QualityModel(flat, np.ones(width), flat, cut, 0.0 if not cut else 1e12, threshold)
    n = good + bad
    centre = over(lambda x, label: x.sum(axis=0)) / n
    scale = np.sqrt(over(lambda x, label: ((x - centre) ** 2).sum(axis=0)) / n)
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights = _least_loss(over, centre, scale, penalty)
    model = QualityModel(centre, scale, weights, 0.0, 1.0, threshold)
    # The quantile lies between the last rejected and the first kept document.
    places = [(None, bad - 1), (None, bad)]
    places += [(1, (good - 1) // 2), (1, good // 2), (0, (bad - 1) // 2), (0, bad // 2)]
    rejected, kept, *middle = _in_order(over, model, places)
    gap = max((middle[0] + middle[1] - middle[2] - middle[3]) / 2, 1e-6)
    return QualityModel(
        centre, scale, weights, float((rejected + kept) / 2), float(8 / gap), threshold
    )


def fit_pairs(
    features: np.ndarray, label: np.ndarray, *, threshold: float = 0.3, penalty: float = 1e-3
) -> QualityModel:
    """Bradley-Terry worths with the least loss over all preference pairs.

    With one label only there is no preference to learn: every document then scores the share of
    label 1, and nothing at all scores 1.
    """
    width = features.shape[1] if features.size else WIDTH
    features = features.reshape(len(label), width)
    return _fit(lambda function: function(features, label), width, threshold, penalty)


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [text_statistics(text).tobytes() for text in batch["text"]]
        yield pd.DataFrame({"id": batch["id"], "features": found})


def _over_rows(rows: DataFrame) -> Over:
    """Sums over ``quality, features`` where they lie; partial sums are added up in a tree."""

    def over(function: Callable):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = nothing
            for batch in batches:
                features = np.frombuffer(b"".join(batch["features"])).reshape(len(batch), WIDTH)
                total = _added(total, function(features, batch["quality"].to_numpy()))
            yield pd.DataFrame({"total": [pickle.dumps(total)]})

        nothing = function(np.zeros((0, WIDTH)), np.zeros(0, np.int64))
        parts = rows.mapInPandas(run, "total binary").rdd.map(lambda row: pickle.loads(row[0]))
        return parts.treeAggregate(nothing, _added, _added)

    return over


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    fold: tuple[int, int] = (5, 0),
    threshold: float = 0.3,
    penalty: float = 1e-3,
) -> QualityModel:
    """Learn from all labelled documents outside the held-out fold, every pair of them.

    Their features are written once; the driver only gets sums, whatever the number of rows. Sums
    are added in any order, so the same rows give the same model to rounding. Ids are matched
    exactly; an id with both labels counts as 0; rows without id or label and labels other than
    0 and 1 teach nothing.
    """
    folds, held = fold
    learns = F.col("id").isNotNull() & (
        F.crc32(F.col("id").cast("string").cast("binary")) % folds != held
    )
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int"))
    known = known.where(learns & F.col("quality").isin(0, 1))
    known = materialise(known.groupBy("id").agg(F.min("quality").alias("quality")), "quality-labels")
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    # Features are narrower than texts, so they are made before the rows move.
    found = texts.where(learns).mapInPandas(_statistics, "id long, features binary")
    rows = found.join(known, "id").select("quality", "features")
    rows = materialise(rows, "quality-features")
    return _fit(_over_rows(rows), WIDTH, threshold, penalty)


def _score(model: QualityModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_statistics(text) for text in batch["text"]]
            scores = model.score(np.array(found).reshape(len(batch), WIDTH))
            yield pd.DataFrame({"id": batch["id"], "score": scores})

    return run


def score_quality(
    docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, score`` for every row of docs, repeated rows included; NULL texts count as empty.

    Only the text goes into a score.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    return texts.mapInPandas(_score(model), "id long, score double")


def keep_quality(docs: DataFrame, model: QualityModel, *, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score reaches the model's threshold, all columns unchanged.

    One pass: whole rows go through the scorer, so nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            found = [text_statistics(text) for text in batch.column(at).to_pylist()]
            scores = model.score(np.array(found).reshape(batch.num_rows, WIDTH))
            yield batch.filter(array(scores >= model.threshold))

    from pyarrow import array

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)
