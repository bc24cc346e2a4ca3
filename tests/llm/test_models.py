"""Parts of the trained models against plain computations; repeated and odd rows; the pipeline as a whole."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest

pytest.importorskip("fundspark.llm")

from fundspark.llm import langid, quality
from fundspark.llm.sampling import hashed_sample

ODD = "doc_id long, text string, lang string, source string, id int, score double, held_out int, quality string"


def odd_docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1, 0.5, 2, "q") for i, t, g in rows], ODD)


# --- Bradley-Terry ------------------------------------------------------------------------------------


def test_pairs_are_fitted_to_the_least_loss():
    """Overlapping classes; the loss is close to that of plain gradient descent over all pairs."""
    rng = np.random.default_rng(1)
    features = np.concatenate([rng.normal(0.6, 1, (80, 4)), rng.normal(-0.6, 1, (60, 4))])
    label = np.repeat([1, 0], [80, 60])
    model = quality.fit_pairs(features, label, penalty=1e-3)
    scaled = (features - features.mean(axis=0)) / features.std(axis=0)
    difference = (scaled[:80, None] - scaled[None, 80:]).reshape(-1, 4)

    def loss(w):
        return np.log1p(np.exp(-difference @ w)).mean() + 0.5e-3 * (w**2).sum()

    w = np.zeros(4)
    for _ in range(3000):
        w += 0.5 * ((difference / (1 + np.exp(difference @ w))[:, None]).mean(axis=0) - 1e-3 * w)
    # It is fitted on a third of the pairs, drawn.
    assert loss(model.weights) < 1.05 * loss(w)
    # The cut is the quantile of the rejected share, and scores 0.3 lies on it.
    worth = model.worth(features)
    assert (worth < model.cut).sum() == 60
    assert abs(model.score(features[np.argsort(worth)[59:61]]).mean() - 0.3) < 0.2


def test_every_pair_counts():
    """20 good and 6,000 bad documents, far more pairs than were ever drawn: the slope of the loss over
    all of them vanishes, and the cut and the slope of the scores are exact order statistics."""
    rng = np.random.default_rng(8)
    features = np.concatenate([rng.normal(0.3, 1, (20, 3)), rng.normal(0, 1, (6_000, 3))])
    label = np.repeat([1, 0], [20, 6_000])
    model = quality.fit_pairs(features, label)
    scaled = (features - features.mean(axis=0)) / features.std(axis=0)
    difference = scaled[:20, None] - scaled[None, 20:]
    lost = 1 / (1 + np.exp(difference @ model.weights))
    slope = -(lost[..., None] * difference).mean(axis=(0, 1)) + 1e-3 * model.weights
    assert np.abs(slope).max() < 1e-6
    worth = model.worth(features)
    assert model.cut == np.sort(worth)[5_999:6_001].mean()
    assert np.isclose(model.slope, 8 / (np.median(worth[:20]) - np.median(worth[20:])), rtol=1e-12)


def test_every_labelled_document_teaches(spark):
    """Also beyond 20,000 of them; over the tables the fit is the one over their rows."""
    rng = np.random.default_rng(9)
    words = np.array("river stone walks under 99 $$ BUY!!! |".split())
    texts = [" ".join(words[rng.integers(0, 6 - 2 * (i % 2), 5) + 2 * (i % 3 == 0)]) for i in range(26_500)]
    docs = odd_docs(spark, [(i, t, "en") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(26_500)], "doc_id long, quality int")
    model = quality.train_quality(docs, labels)
    learns = [i for i in range(26_500) if zlib.crc32(str(i).encode()) % 5 != 0]
    assert len(learns) > 21_000
    features = np.array([quality.text_statistics(texts[i]) for i in learns])
    want = quality.fit_pairs(features, np.array(learns) % 2)
    assert np.allclose(model.centre, features.mean(axis=0), rtol=1e-9, atol=1e-12)
    assert np.allclose(model.weights, want.weights, atol=1e-5)
    assert np.isclose(model.cut, want.cut, atol=1e-5) and np.isclose(model.slope, want.slope, rtol=1e-5)


def test_word_buckets_equal_a_plain_count():
    words = b"The cat the CAT sat".split()
    found = quality.word_buckets(words, dict.fromkeys(words, 1))
    want = np.zeros(quality.GRAM_BUCKETS)
    code = [zlib.crc32(w.lower()) for w in words]
    for c in code:
        want[c % quality.GRAM_BUCKETS] += 1
    for a, b in zip(code, code[1:]):
        want[(((a * 0x9E3779B1 + b) % 2**64) >> 7) % quality.GRAM_BUCKETS] += 1
    assert np.allclose(found, want / 5)
    assert len(quality.text_statistics("one")) == len(quality.text_statistics(None)) == quality.WIDTH


def test_quality_of_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, " ".join(rng.choice(["river", "stone", "walks", "under"], 40)) + ".", "en") for i in range(60)]
    bad = [(100 + i, "BUY!!! " * 30 + "$$ 99 | | |", "en") for i in range(60)]
    odd = [(None, "no id", None), (500, None, None), (501, "", None), (502, "word " * 200_000, "en"), (503, " \n ", None)]
    docs = odd_docs(spark, good + bad + odd + good[:10] + good[:10])
    labels = spark.createDataFrame(
        [(i, 1, "x") for i, *_ in good] + [(i, 0, "x") for i, *_ in bad] + [(None, 1, "x"), (7, None, "x"), (500, 5, "x"), (3, 0, "x")],
        "doc_id long, quality int, score string",
    )
    model = quality.train_quality(docs, labels)
    scored = quality.score_quality(docs, model).collect()
    assert len(scored) == 145 and all(0 <= r["score"] <= 1 for r in scored)
    of = collections.defaultdict(set)
    for r in scored:
        of[r["id"]].add(r["score"])
    assert all(len(x) == 1 for x in of.values())  # rows that repeat score alike
    assert np.mean([min(of[i]) >= 0.3 for i, *_ in good]) > 0.95 and np.mean([max(of[i]) < 0.3 for i, *_ in bad]) > 0.95
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id = 1").count() == 3


def test_a_sample_is_not_filled_by_repeats(spark):
    rows = spark.range(5_000).selectExpr("id", "'t' as text").union(spark.range(50_000).selectExpr("7L", "'same'"))
    sample = hashed_sample(rows, ["id", "text"], 1_000, 5)
    assert sample.count() < 1_100 and sample.where("text = 'same'").count() <= 1
    few = spark.range(10).union(spark.range(10))
    assert hashed_sample(few, "id", 100, 5).count() == 10


# --- languages ----------------------------------------------------------------------------------------


def plain_ftrl(examples, classes, alpha, beta, l1, l2, epochs, seed):
    """One coordinate at a time, as published."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i, c):
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - math.copysign(l1, z[i, c])) / ((beta + math.sqrt(n[i, c])) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in rng.permutation(len(examples)):
            rows, values, label = examples[at]
            now = {(i, c): weight(i, c) for i in rows for c in range(classes)}
            logits = [sum(v * now[i, c] for i, v in zip(rows, values)) for c in range(classes)]
            total = sum(math.exp(x - max(logits)) for x in logits)
            for c in range(classes):
                error = math.exp(logits[c] - max(logits)) / total - (c == label)
                for i, v in zip(rows, values):
                    g = v * error
                    rate = (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / alpha
                    z[i, c] += g - rate * now[i, c]
                    n[i, c] += g * g
    return {(i, c): weight(i, c) for i, c in z}


def test_the_leader_equals_a_plain_computation():
    rng = np.random.default_rng(4)
    examples = []
    for _ in range(25):
        rows = np.sort(rng.choice(30, 6, replace=False))
        examples.append((rows, rng.random(6), int(rng.integers(3))))
    settings = {"alpha": 1.0, "beta": 1.0, "l1": 0.05, "l2": 0.01, "epochs": 3, "seed": 9}
    found = langid.follow_leader(examples, 3, **settings)
    want = plain_ftrl(examples, 3, **settings)
    for (i, c), w in want.items():
        assert abs(found[i, c] - w) < 1e-9
    assert (found[:30] == 0).any() and not found[30:].any()


def test_the_temperature_has_the_least_loss():
    rng = np.random.default_rng(5)
    logits = rng.normal(0, 4, (300, 3))
    labels = np.array([rng.choice(3, p=langid.softmax(row / 2.5)) for row in logits])

    def loss(t):
        return -np.log(langid.softmax(logits / t)[np.arange(300), labels]).mean()

    best = min(np.exp(np.linspace(np.log(0.3), np.log(15), 400)), key=loss)
    assert abs(langid.fit_temperature(logits, labels) / best - 1) < 0.02
    assert langid.fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_tf_idf_has_length_one_and_plain_weights():
    idf = np.linspace(1, 3, langid.BUCKETS)
    found, values = langid.tf_idf("Abba ab", idf)
    assert abs(np.linalg.norm(values) - 1) < 1e-12
    grams, counts = langid.gram_counts("Abba ab")
    assert list(grams) == list(found) and counts.sum() == 9 + 8 + 7
    raw = (1 + np.log(counts)) * idf[grams]
    assert np.allclose(values, raw / np.linalg.norm(raw))


def test_languages_of_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(6)
    words = {"aa": ["bolo", "rami", "tosk"], "zz": ["wexy", "quiz", "juxt"]}
    rows = [(i, " ".join(rng.choice(words[g], 20)), g) for i, g in enumerate(["aa", "zz"] * 60)]
    odd = [(None, "bolo rami", "aa"), (900, None, "aa"), (901, "", None), (902, "123 !", "zz"), (903, "wexy " * 150_000, None)]
    docs = odd_docs(spark, rows + odd + rows[:12] + rows[:12])
    model = langid.train_languages(docs)
    found = langid.identify(docs, model).collect()
    assert len(found) == 149 and all(0 <= r["score"] <= 1 for r in found)
    by = collections.defaultdict(set)
    for r in found:
        by[r["id"]].add((r["lang_pred"], r["score"]))
    assert all(len(x) == 1 for x in by.values())
    assert all(next(iter(by[i]))[0] == g for i, _, g in rows)
    assert {next(iter(by[i]))[0] for i in (900, 901, 902)} == {"und"} and next(iter(by[903]))[0] == "zz"
    assert langid.identify(docs.limit(0), langid.train_languages(docs.limit(0))).count() == 0


# --- the pipeline -------------------------------------------------------------------------------------


def test_the_whole_pipeline_keeps_and_packs_by_its_rules(spark):
    """``run`` over all rows: every sequence is gapless, and every piece is of a document that its
    stages, called one after another, have kept."""
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    placed = pipeline.run(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf).cache()
    copies = collections.Counter(r["doc_id"] for r in docs.collect())
    assert copies == collections.Counter(r["doc_id"] for r in placed if r["piece"] == 0)
    sequences = collections.defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    # As few sequences as the tokens need, or nearly so.
    total = sum(r["length"] for r in placed)
    assert len(sequences) <= -(-total // 4096) + 1


def test_every_stage_takes_odd_and_repeated_rows(spark):
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, "Words without an id", "en", None, 19), (900001, None, None, "web", 0), (900002, "", "en", "web", 0),
         (900003, "word " * 300_000, "en", "web", 1)], docs.schema,
    )
    repeated = docs.where("doc_id % 10 = 3")
    mixed = docs.unionByName(odd).unionByName(repeated).unionByName(repeated)
    for name, stage in pipeline.STAGES:
        after = stage(spark, mixed, sf)
        assert after.count() > 0 and stage(spark, mixed.limit(0), sf).count() == 0, name
        if name != "packing":
            assert after.columns == docs.columns
    assert pipeline.STAGES[4][1](spark, mixed, sf).where("piece = 0").count() == mixed.count()
