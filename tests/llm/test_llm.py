"""The training-data operators against brute force, round trips and odd rows."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

pytest.importorskip("fundspark.llm")

from fundspark.llm import ann, html_extract, langid, licenses, mixing, near_dedup, packing, quality, topk, warc
from fundspark.llm.components import components
from fundspark.llm.near_dedup import near_duplicates
from fundspark.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, key string, size int, component_id int"
WORDS = [f"w{i}" for i in range(400)]


def make_docs(spark, rows):
    """Texts with ids, plus columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", "k", 1, 2) for i, t in rows], DOCS)


def random_text(rng, n):
    return " ".join(rng.choice(WORDS, n))


def odd_rows(rng):
    long = random_text(rng, 30_000)
    return [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, long), (6, long), (None, "no id here at all")]


def sets_of(rows, size):
    out = {}
    for i, text in rows:
        words = (text or "").lower().split()
        grams = [tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))]
        out[i] = set(grams) if words else set()
    return out


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40, 70)] + [(5, i) for i in range(6, 30)] + [(100, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(40, 71)} == {40}
    assert {found[i] for i in [*range(5, 30), 100]} == {5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = odd_rows(rng)
    for group in range(12):  # copies with more and more edits
        words = rng.choice(WORDS, 150)
        for copy in range(14):
            rows.append((100 * group + 10 + copy, " ".join(words)))
            for _ in range(rng.integers(0, 3)):
                words = words.copy()
                words[rng.integers(0, 150)] = f"x{rng.integers(0, 10**6)}"
    found = {r["doc_id"]: r for r in near_duplicates(make_docs(spark, rows), shingle_words=4).collect()}
    sets = sets_of([r for r in rows if r[0] is not None], 4)
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    assert len(found) == len(rows)
    for i, grams in sets.items():
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(grams), top(i)), i
        assert found[i]["kept"] == (top(i) == i)
    assert found[None]["kept"] and found[None]["component_id"] is None
    assert near_duplicates(make_docs(spark, [])).count() == 0


def test_one_large_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.choice(WORDS, 120)
    rows = []
    for i in range(900):
        words = base.copy()
        for at in rng.integers(0, 120, rng.integers(0, 10)):
            words[at] = f"y{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(make_docs(spark, rows), shingle_words=4).collect()}
    sets = sets_of(rows, 4)
    apart = [
        (i, j)
        for i in sets
        for j in sets
        if i < j and found[i] != found[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    assert not apart


def test_pairs_at_the_limit_are_not_lost_to_estimates(spark):
    """Pairs sharing 8 of 10 words whose signatures look less alike than they are."""
    rng = np.random.default_rng(13)
    coarse, fine = near_dedup._multipliers(60, 7), near_dedup._multipliers(256, 7)
    far = 0
    for _ in range(8000):
        sets = rng.choice(2**62, 10, replace=False).astype(np.uint64)
        one, two = np.sort(sets[:9]), np.sort(np.append(sets[:8], sets[9]))
        x, y = (near_dedup.least_hashes(s, coarse).astype("<u2") for s in (one, two))
        differ = (x != y).reshape(near_dedup.CHUNKS, near_dedup.WIDTH)
        errors = differ.sum(axis=1)
        if errors.sum() < 24 or errors.min() > 1:
            continue
        far += 1
        chunk = (errors <= 1).argmax()
        rows = [
            (5, int(chunk * near_dedup.WIDTH + differ[chunk].argmax()), i, i, 9, sig.tobytes(), near_dedup.bin_counts(s).tobytes(), outer, 0, 0)
            for i, sig, s, outer in ((1, x, one, True), (2, y, two, False))
        ]
        names = ["key", "slot", "id", "root", "n", "signature", "bins", "outer", "block_a", "block_b"]
        pairs = near_dedup._block_pairs(80)(pd.DataFrame(rows, columns=names))
        assert pairs.values.tolist() == [[1, 2]]
        if far == 2:
            break
    assert far
    texts, hashes = [], near_dedup.WordHashes()
    for at in range(20000):
        words = [f"v{at}x{i}" for i in range(10)]
        pair = " ".join(words[:9]), " ".join(words[:8] + words[9:])
        x, y = (near_dedup.least_hashes(near_dedup.shingle_set(t, 1, hashes), fine).astype(np.uint8) for t in pair)
        if (x == y).sum() < 0.7125 * 256:
            texts += pair
            if len(texts) == 4:
                break
    assert len(texts) == 4
    found = near_duplicates(make_docs(spark, list(enumerate(texts))), shingle_words=1, percent=80).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i // 2 * 2 for i in range(len(texts))}


def test_groups_of_cells_stay_small_in_large_buckets(spark, monkeypatch):
    def sizes(percent):
        return lambda rows: pd.DataFrame({"a": [len(rows)], "b": [int(rows["id"].sum())]})

    monkeypatch.setattr(near_dedup, "_block_pairs", sizes)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "GROUP_ROWS", 200)
    count = 400  # members of one bucket, none linked with another
    members = spark.range(count).selectExpr("1L as key", "0 as slot", "id", f"{count}L as size")
    centres = spark.createDataFrame([(1, 0)], "key long, centre long")
    roots = spark.createDataFrame([], "node long, root long")
    nodes = spark.range(count).selectExpr("id", "cast('s' as binary) as signature")
    profiles = spark.range(count).selectExpr("id", "1L as n", "cast('b' as binary) as bins")
    groups = [r["a"] for r in near_dedup._rest(members, centres, roots, nodes, profiles, 80).collect()]
    assert sum(groups) == (count - 1) * 50 + count * 50
    assert max(groups) <= 4 * 200


def test_weighing_never_loses_a_link():
    rng = np.random.default_rng(14)
    for size in (1, 9, 200, 5000, 120_000):
        for kept in (1.0, 0.9, 0.89, 0.5):
            one = rng.integers(0, 2**62, size, np.uint64)
            two = np.append(one[: int(size * kept)], rng.integers(0, 2**62, size - int(size * kept), np.uint64))
            both = len(np.intersect1d(one, two))
            bins = [near_dedup.bin_counts(x)[None] for x in (one, two)]
            can = near_dedup.can_link(np.array([size]), bins[0], np.array([size]), bins[1], 80)[0]
            assert can or 100 * both < 80 * (2 * size - both)
    assert not near_dedup.can_link(np.array([200]), bins[0] * 0, np.array([200]), bins[1] * 0, 80)[0]


def test_quality_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train_quality(docs, labels)
    rows = quality.score_quality(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id").collect()
    held = [r for r in rows if zlib.crc32(str(r["id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in held]) >= 0.95
    odd = make_docs(spark, odd_rows(np.random.default_rng(3)))
    scores = quality.score_quality(odd, model).collect()
    assert len(scores) == 7 and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.keep_quality(odd, model).schema == odd.schema
    nothing = quality.train_quality(odd.limit(0), labels.limit(0))
    assert quality.score_quality(odd, nothing).count() == 7


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train_languages(docs)
    rows = langid.identify(docs, model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").collect()
    held = [r for r in rows if zlib.crc32(str(r["id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97
    odd = make_docs(spark, [*odd_rows(np.random.default_rng(4)), (9, "12 34 !!")])
    found = {r["id"]: r for r in langid.identify(odd, model).collect()}
    assert {found[i]["lang_pred"] for i in (1, 2, 3, 9)} == {"und"} and found[5]["lang_pred"] != "und"
    empty = langid.train_languages(odd.limit(0))
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}
    assert langid.keep_identified(odd, model).schema == odd.schema


VECTORS = "vec_id long, embedding array<float>, id string, v int, bundle int"


def make_vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


def test_top_products_and_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1500, 16)).astype(np.float32)
    vectors[300:800] = vectors[300]  # a third are copies of one vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(None, rows[0][1]), (5000, None), (5100, []), (5200, [float("nan")] * 16), (5300, [1.0, None])]
    table = make_vectors(spark, rows + odd)
    whole = np.floor(1024 * vectors.astype(float))
    found = {}
    for r in topk.top_products(table).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == list(range(0, 1500, 100))
    for q, ranks in found.items():
        score = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:10]
        assert [ranks[n] for n in range(1, 11)] == [(i, score[i]) for i in best]
    hits = 0
    near = {}
    for r in ann.nearest_neighbours(table).collect():
        near.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    for q, ranks in near.items():
        away = np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(1500), away)) if i != q][:10]
        hits += len(set(best) & {i for i, _ in ranks.values()})
        assert all(abs(away[i] - d) < 1e-12 for i, d in ranks.values()) and sorted(ranks) == list(range(1, 11))
    assert hits >= 0.9 * 150
    few = make_vectors(spark, rows[:3])
    assert topk.top_products(few).count() == 2 and ann.nearest_neighbours(few).count() == 2
    assert topk.top_products(few.limit(0)).count() == 0 and ann.nearest_neighbours(few.limit(0)).count() == 0


def test_neighbours_are_the_same_in_small_blocks(spark, monkeypatch):
    vectors = np.random.default_rng(6).normal(size=(1500, 16)).tolist()
    table = make_vectors(spark, [*enumerate(vectors), (None, vectors[0])])
    whole = sorted(ann.nearest_neighbours(table).collect())
    monkeypatch.setattr(ann, "QUERIES", 4)
    monkeypatch.setattr(ann, "BUNDLE_ROWS", 256)
    assert sorted(ann.nearest_neighbours(table).collect()) == whole and len(whole) == 150


def test_huge_components_stay_exact():
    found, score = topk._exact(np.array([[2.0**40, 1], [2.0**30, 3]]), np.array([1, 2]), np.array([2.0**20, 5]), 0, 2)
    assert found.tolist() == [1, 2] and score.tolist() == [2**60 + 5, 2**50 + 15]


PAGE = (
    '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li>Home</ul></nav>'
    '<div class="ad">Buy &amp; go</div><article><h1>Head &lt;1&gt;</h1><p><b>Some   bold<br><p>Text {0} &eacute;'
    '</p><div class="comments"><p>Nice!</p></div></article><div>Old news</div><footer>&copy; Us</footer></body></html>'
)


def test_pages(spark):
    bare = "<body><div><p>Words of page {0}</p></div><div id=x{0}><p>Same on all pages</p></div></body>"
    rows = [(i, f"http://h.example/{i}", PAGE.format(i)) for i in range(30)]
    rows += [(100 + i, f"http://bare.example/{i}", bare.format(i)) for i in range(60)]
    rows += [(200, None, PAGE.format(0)), (201, "http://h.example/x", None), (202, "", ""), (None, "http://h.example/0", PAGE.format(0))]
    rows += [(203, "http://one.example/", "<p>Only <i>one</i> page</div> <li>and more"), (204, "http://one.example/", "plain < text &")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, tree string")
    found = {r["page_id"]: r for r in html_extract.extract_pages(pages).collect()}
    assert len(found) == len(rows)
    for i in range(30):
        assert found[i]["text"] == f"Head <1>\nSome bold\nText {i} é" and found[i]["n_chars"] == len(found[i]["text"])
    assert found[100]["text"] == "Words of page 0"  # told from the style tree alone
    assert found[200]["text"] == found[None]["text"] == found[0]["text"]
    assert found[201]["text"] == found[202]["text"] == ""
    assert found[203]["text"] == "Only one page\nand more" and found[204]["text"] == "plain < text &"
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<datalist><option>A<option>B</datalist><article><p>Story</p></article>", "Story"),
        ("<option>A<option>B<div><p>Story</p></div>", "Story"),
        ("<form><select><optgroup><option>A<option>B</select></form><p>Story</p>", "Story"),
        ("<select><option>A<option>B<article><p>Story</p></article>", "Story"),
        ("<article><p>See <svg/>here <math/>and</p><p>there</p></article>", "See here and\nthere"),
        ("<p>See <svg><text>no</text><svg a='>'><text>no</text></svg></svg>here</p><p>on</p>", "See here\non"),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> holds</p></article>", "So x=1 holds"),
        ("<article><noscript><p>Plain story</p></noscript></article>", "Plain story"),
        ("<iframe src=a><p>Story</p><iframe src=b>no</iframe><template><p>no</p></template><p>End</p>", "Story\nEnd"),
        ("<svg><path><p>Story</p><!-- </svg> --><p>End</p>", "Story\nEnd"),
        ("<p>Story</p><script>if (a<b) '<p>'", "Story"),
    ],
)
def test_open_elements_do_not_cut_the_page(html, text):
    assert html_extract.main_text(f"<html><body>{html}", {}) == text


def test_copies_of_a_page_count_once_on_their_host(spark):
    rng = np.random.default_rng(12)
    nav = "<div class='links'>Home News Contact</div>"

    def page(text):
        return f"<html><body>{nav}<article><div class='body'><p>{text}</p></div></article></body></html>"

    texts = ["the copied story"] * 1000 + [random_text(rng, 30) for _ in range(50)]
    rows = [(i, f"http://h.org/{i}", page(t)) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert found == dict(enumerate(texts))


def test_bins_are_full_and_complete():
    rng = np.random.default_rng(6)
    lengths = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 200, 700), return_counts=True), strict=True)}
    left = dict(lengths)
    for chosen, bins in packing.plan_bins(lengths, 200):
        assert sum(size * times for size, times in chosen) <= 200
        for size, times in chosen:
            left[size] -= times * bins
    assert not any(left.values())
    assert packing.fullest({7: 1, 5: 3, 2: 1}, 17) == [(7, 1), (5, 2)]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rng = np.random.default_rng(7)
    texts = [*odd_rows(rng), (7, "Don't STOP\x1cnow, <|endoftext|> Σας İ 東京 café 1²3"), (8, "again"), (8, "again")]
    texts += [(i, random_text(rng, int(n))) for i, n in enumerate(rng.integers(1, 3000, 60), 20)]
    rows = packing.pack(make_docs(spark, texts), tokenizer_path(), part_rows=7).collect()
    expected = []
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected.append((i, piece, start, len(part), zlib.crc32(part.tobytes())))
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r[:5]) for r in rows), key=order) == sorted(expected, key=order)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(e[3] for e in expected) // 4096) + 1
    assert packing.pack(make_docs(spark, []), tokenizer_path()).count() == 0


def test_licenses(spark):
    notice = "intro words. Licensed under the very Apache License,\nVersion 2.0! cc-by CC/BY; MIT-License"
    rows = [(1, None), (2, ""), (3, notice), (3, "other"), (None, "the MIT license"), (4, "gnu general public licence"), (5, "mit")]
    rows += [(6, "x " * 50_000 + "GNU general PUBLIC license")]
    found = [r for r in licenses.scan_licenses(make_docs(spark, rows)).collect()]
    assert len(found) == len(rows)
    by = {(r["doc_id"], r["n_words"]): r for r in found}
    full = by[3, 17]
    assert (full["n_base"], full["first_word"], full["last_word"]) == (4, 6, 15)
    assert full["base_labels"] == "apache,cc-by,mit" and full["score"] == 1
    assert by[3, 1]["labels"] == "" and by[3, 1]["score"] == 0 and by[3, 1]["first_word"] is None
    assert by[None, 3]["base_labels"] == "mit" and by[4, 4]["n_base"] == 0
    assert by[6, 50_004]["first_word"] == 50_000 and by[1, 0]["n_base"] == by[2, 0]["n_base"] == 0
    text = licenses.NOTICES[0][1].replace("any person", "any other person")
    spans = licenses.notice_spans(make_docs(spark, [(1, f"a b {text} c"), (2, "free of charge to any person")])).collect()
    assert [(r["doc_id"], r["label"], r["first"]) for r in spans] == [(1, "mit", 2)]
    assert licenses.scan_licenses(make_docs(spark, [])).count() == 0


def test_archives_round_trip(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "same") for i in range(40)]
    rows += [(50, None, None), (51, "u\nv", ""), (52, "http://x", "é" * 400_000), (52, "http://x", "é" * 400_000), (None, "n", "same"), (None, "n", "alone")]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    folder, index = warc.write_archives(pages, str(tmp_path / "warc"))
    found = warc.read_archives(spark, folder, index).collect()
    assert len(found) == len(rows)
    for r in found:
        html = next(h or "" for p, u, h in rows if p == r["page_id"] and len((h or "").encode()) == r["payload_bytes"])
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r["payload_digest"] == digest
        keeper = max((p for p, _, h in rows if (h or "") == html and p is not None), default=None)
        revisit = keeper is not None and r["page_id"] != keeper
        assert (r["record_type"], r["refers_to"]) == (("revisit", keeper) if revisit else ("response", None))
        assert revisit or r["body_digest"] == digest
    for entry in index.collect():
        head, _ = warc.read_record(folder, entry["bundle"], entry["frame"], entry["frame_offset"])
        assert head["WARC-Record-ID"] == entry["record_id"]
    small = warc.write_archives(pages, str(tmp_path / "small"), min_payload_bytes=5)
    assert warc.read_archives(spark, *small).where("record_type = 'revisit'").count() == 0
    none = warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, *none).count() == 0


def test_mixing_meets_its_rates(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").alias("source"),
        F.lit(None).cast("string").alias("text"),
        F.lit(1).alias("position"),
    )
    targets = spark.createDataFrame([("hot", 1.0), ("cold", 2.0), (None, 40.0)], "source string, weight double")
    rates = mixing.source_rates(docs, targets, epochs=2.0)
    mixed = mixing.mix_sources(docs, rates, seed=1)
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, weight in (("hot", 1), ("cold", 2), (None, 40)):
        mean = 40_000 * weight / 43
        assert abs(counts[source] - mean) < 6 * mean**0.5
    assert mixed.columns == ["doc_id", "source", "text", "copy", "position"]
    again = mixing.mix_sources(docs.repartition(3), rates, seed=1)
    assert again.exceptAll(mixed).count() == 0
    assert mixing.mix_sources(docs.limit(0), mixing.source_rates(docs.limit(0))).count() == 0
    repeated = docs.where("doc_id < 5").union(docs.where("doc_id < 5"))
    assert mixing.mix_sources(repeated, mixing.source_rates(repeated)).count() % 2 == 0


def test_pipeline_stages_equal_their_rules(spark):
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:4]:
        after = stage(spark, docs, sf).cache()
        assert after.columns == columns
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        left = [r["doc_id"] for r in after.collect()]
        if name == "near_dedup":
            sets = sets_of(texts.items(), 5)
            for i in left:
                for j in left:
                    assert i == j or not sets[i] or 100 * len(sets[i] & sets[j]) < 80 * len(sets[i] | sets[j])
        if name != "mixing":
            assert len(left) == len(set(left)) and len(left) >= 0.6 * len(texts)
        docs = after
    packed = pipeline.STAGES[4][1](spark, docs, sf)
    assert packed.where("piece = 0").count() == docs.count()


def test_near_duplicates_hand_workers_small_batches(spark, monkeypatch):
    """Texts and shingle sets are wide: every step that is written gives workers few rows at a time."""
    setting, used = "spark.sql.execution.arrow.maxRecordsPerBatch", set()
    written = near_dedup.materialise

    def watched(df, name):
        used.add(int(spark.conf.get(setting)))
        return written(df, name)

    monkeypatch.setattr(near_dedup, "materialise", watched)
    before = spark.conf.get(setting)
    text = " ".join(WORDS[:60])
    rows = [(i, text + f" more{i % 7}") for i in range(40)]
    found = near_duplicates(make_docs(spark, rows), shingle_words=4, percent=80).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 40
    assert used and max(used) <= 1_000
    assert spark.conf.get(setting) == before


def test_batches_are_bounded_by_rows_and_bytes(spark):
    from fundspark.llm.batches import bounded_batches

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [len(batch)]})

    rows = spark.range(0, 3_000, 1, 1).selectExpr("repeat('x', 1000) as text")
    with bounded_batches(spark, rows=400):
        assert max(r["n"] for r in rows.mapInPandas(sizes, "n long").collect()) == 400
    with bounded_batches(spark, most=100_000):
        assert max(r["n"] for r in rows.mapInPandas(sizes, "n long").collect()) <= 200
    with pytest.raises(ValueError), bounded_batches(spark):
        raise ValueError
    assert max(r["n"] for r in rows.mapInPandas(sizes, "n long").collect()) > 1_000
