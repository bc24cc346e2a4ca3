"""Collocations, ranked search and subwords against brute force; what the other operators must tell apart."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
from array import array

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("fundspark.llm")

from fundspark.llm import ann, collocations, html_extract, lexical, licenses, mixing, packing, subwords, warc
from fundspark.llm.queries import piece_model, tokenizer_path
from fundspark.llm.words import BREAK, bounded, byte_kinds, split_words

CLASHING = "doc_id long, text string, lang string, words int, code long, row int, rank int, score double, n int"


def make_docs(spark, rows):
    """``(id, text, lang)`` with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, g, 1, 2, 3, 4, 0.5, 6) for i, t, g in rows], CLASHING)


# --- words ------------------------------------------------------------------------------------------


def test_words_equal_a_regular_expression():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB é.\n\t") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = split_words(pa.array(texts), byte_kinds(b" \t", b".\n"))
    words = found.words.to_pylist()
    mine = [[] for _ in texts]
    for doc, code, piece in zip(found.doc, found.codes, found.piece, strict=True):
        mine[doc].append((words[code].decode(), piece))
    for text, got in zip(texts, mine, strict=True):
        pieces = [re.findall(r"[^ \t]+", p) for p in re.split(r"[.\n]", text.replace("B", "b"))]
        assert [w for w, _ in got] == [w for p in pieces for w in p]
        groups = [n for n, p in enumerate(pieces) for _ in p]
        assert [a == b for a, b in zip(groups, groups[1:])] == [a[1] == b[1] for a, b in zip(got, got[1:])]
    assert BREAK == 2 and not len(split_words(pa.array([], pa.string()), byte_kinds(b" ")).doc)


def test_bounded_slices_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["", "a" * 30, "b", "", "c" * 9, ""])], ["text"])
    for most in (1, 5, 10, 100):
        parts = list(bounded(batch, most=most))
        assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()


# --- op11 -------------------------------------------------------------------------------------------


def plain_collocations(rows, least, longest, percent, first):
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in candidates.items():
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [
                c for q, c in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if not any(100 * c >= percent * a for c in longer):
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_equal_brute_force(spark, longest, monkeypatch):
    rng = np.random.default_rng(longest)
    vocabulary = [f"w{i}" for i in range(12)] + ["The", "émile", "B.", "c,d", "x\ty", "z\r\nz"]
    rows = [(i, " ".join(rng.choice(vocabulary, 60)), ["en", "de", None][i % 3]) for i in range(60)]
    rows += [(1, rows[1][1], "en"), (None, None, "en"), (70, "", None), (71, " \t", "fr"), (72, "w1 w2 " * 20_000, "de")]
    monkeypatch.setattr(collocations, "AT_ONCE", 500)
    found = collocations.collocations(make_docs(spark, rows), least=4, longest=longest, first=40, block=37)
    mine = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.collect())
    assert mine == plain_collocations(rows, 4, longest, 50, 40) and len(mine) > 40


def test_a_word_has_one_hash_whatever_stands_beside_it():
    rng = np.random.default_rng(3)
    words = list({bytes(rng.integers(97, 101, rng.integers(1, 8)).astype(np.uint8)) for _ in range(3_000)})
    words += [b"a" * collocations.LONG_WORD, b"a" * (collocations.LONG_WORD + 1), "é".encode() * 9_000]
    found = collocations.word_hashes(pa.array(words, pa.binary()))
    alone = [int(collocations.word_hashes(pa.array([w], pa.binary()))[0]) for w in words[-400:]]
    assert found[-400:].tolist() == alone and len(set(found.tolist())) == len(words)
    assert len(collocations.word_hashes(pa.array([], pa.binary()))) == 0


@pytest.mark.parametrize("large", [10, 2**40])
def test_distinct_rows_equal_a_plain_count(large):
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 5, 700) * large for _ in range(3)]
    first, count = collocations.distinct_rows(columns)
    plain = collections.Counter(zip(*(c.tolist() for c in columns), strict=True))
    assert {tuple(int(c[i]) for c in columns): int(n) for i, n in zip(first, count, strict=True)} == plain


def test_no_collocations_in_empty_tables(spark):
    assert collocations.collocations(make_docs(spark, [])).count() == 0
    assert collocations.collocations(make_docs(spark, [(1, "a b", "en"), (2, None, None)])).count() == 0


def test_candidates_under_one_hash_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(collocations, "mix", lambda key, word: (key ^ word) & np.uint64(1))
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(rng.choice([f"w{j}" for j in range(9)], 40)), "en") for i in range(20)]
    found = collocations.collocations(make_docs(spark, rows), least=5, first=100)
    mine = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.collect())
    assert mine == plain_collocations(rows, 5, 3, 50, 100)


# --- op12 -------------------------------------------------------------------------------------------


def plain_ranking(rows, items, k):
    def terms(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)

    docs = [(i, collections.Counter(terms(t))) for i, t, _ in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for item, text in set(items):
        wanted[item].update(terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for i, c in docs:
            m = 100 - 75 + (75 * sum(c.values()) * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in query.items() if c[t]
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("pass_chars", [40, 1 << 20])
def test_ranking_equals_brute_force(spark, pass_chars, monkeypatch):
    rng = np.random.default_rng(4)
    vocabulary = [f"t{i}" for i in range(80)] + ["Über", "x1", "a-b", "the"]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 30))), None) for i in range(300)]
    # Ties by copies, repeated rows, odd ones, and a long text.
    rows += [(1000 + i, rows[i][1], None) for i in range(20)] + [rows[5], rows[5], (None, rows[7][1], None)]
    rows += [(2000, None, None), (2001, "", None), (2002, " -,. ", None), (2003, "t1 t2 " * 40_000, None)]
    items = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(70)]
    items += [(3, items[3][1]), (4, "t9 t9 unknown"), (80, ""), (81, None), (82, "nowhere"), (None, "t3 t4")]
    table = spark.createDataFrame([(*i, "k") for i in items], "item_id long, text string, doc_id string")
    monkeypatch.setattr(lexical, "ROWS_IN_BLOCK", 64)
    monkeypatch.setattr(lexical, "ITEMS_IN_TILE", 9)
    found = lexical.rank_documents(make_docs(spark, rows), table, k=7, pass_chars=pass_chars)
    mine = sorted([tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()], key=str)
    assert mine == plain_ranking(rows, items, 7)


def test_ranking_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = make_docs(spark, [(1, "a b c", None), (2, "d", None)])
    assert lexical.rank_documents(make_docs(spark, []), items).count() == 0
    assert lexical.rank_documents(make_docs(spark, [(1, " ", None)]), items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in lexical.rank_documents(docs, items).collect()] == [(1, 1, 1)]


def test_sums_stay_exact_beyond_doubles():
    """Heavy items: in one product their sums would pass 2**53."""
    rng = np.random.default_rng(8)
    weighted = [{t: int(rng.integers(1, 2**34)) for t in range(40)}, {0: 2**36, 7: 3}, {}]
    panels = lexical.panels_of(weighted, most_terms=16)
    for terms, weights in panels:
        assert len(terms) <= 16 and (weights.sum(axis=0) * lexical.MOST_IMPACT < lexical.EXACT).all()
    tile = lexical.Tile(np.arange(3), panels)
    row, term = np.divmod(np.arange(5 * 40), 40)
    impact = rng.integers(900_000, 1_000_000, len(row))
    scores = lexical.block_scores(tile, lexical.Block.of(5, row, term, impact))
    for r in range(5):
        for i, own in enumerate(weighted):
            assert scores[r, i] == sum(w * int(impact[40 * r + t]) for t, w in own.items())
    assert scores.max() > lexical.EXACT


# --- op13 and op7 -----------------------------------------------------------------------------------


def odd_texts():
    rng = random.Random(5)
    parts = [*"ab  \n\t.▁é한😀\x00�　\xa0'1A", "the ", "  ", "</s>", "ing", "<0x41>", "Don't "]
    texts = ["", " ", "   ", " a", "a ", "▁", "a▁ ", "x" * 30_000, "long text " * 9000]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]


def test_subwords_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    texts = odd_texts()
    rows = [*enumerate(texts), (-1, None), (None, "no id"), (3, texts[3])]
    docs = make_docs(spark, [(i, t, None) for i, t in rows])
    found = collections.Counter(tuple(r) for r in subwords.encode_documents(docs, piece_model()).collect())
    want = collections.Counter()
    for i, text in rows:
        ids = model.encode(text or "", add_eos=True)
        joined, decoded = " ".join(map(str, ids)), model.decode(ids)
        want[i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, decoded))] += 1
    assert found == want
    assert subwords.encode_documents(make_docs(spark, []), piece_model()).count() == 0


def test_subwords_of_a_full_table(monkeypatch):
    monkeypatch.setattr(subwords, "WORDS_KEPT", 3)
    monkeypatch.setattr(subwords, "LONGEST_KEPT", 2)
    table = subwords.ChunkTable(piece_model())
    first = subwords.encode_block(table, pa.array(["some words here", "abc abc"]), 2)
    again = subwords.encode_block(table, pa.array(["some words here", "abc abc"]), 2)
    assert [list(x) for x in first] == [list(x) for x in again] and len(table.known) <= 3


def test_packed_ids_equal_the_tokenizer():
    from pathlib import Path

    encoder = packing.Encoder(Path(tokenizer_path()).read_text(encoding="utf-8"))
    texts = [*odd_texts(), "İstanbul ſ ǅ", "we'll 's 12 a_b <|endoftext|> x", "ÀÉ don't,stop!"]
    for text, ids in zip(texts, encoder(texts), strict=True):
        assert ids == array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    assert encoder.by_word


# --- op3 --------------------------------------------------------------------------------------------


def test_neighbours_of_repeated_rows(spark):
    vectors = np.random.default_rng(3).normal(size=(600, 12)).tolist()
    table = spark.createDataFrame([*enumerate(vectors)], "vec_id long, embedding array<double>")
    once = sorted(tuple(r) for r in ann.nearest_neighbours(table).collect())
    assert len(once) == 60
    for times in (2, 3, 5):
        united = table
        for _ in range(times - 1):
            united = united.union(table)
        assert sorted(tuple(r) for r in ann.nearest_neighbours(united).collect()) == once
    whole, hits = np.array(vectors), 0
    for q in range(0, 600, 100):
        away = np.sqrt(((whole - whole[q]) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(600), away)) if i != q][:10]
        hits += len(set(best) & {r[2] for r in once if r[0] == q})
    assert hits >= 0.95 * 60
    # One row far more often than all others: the sample is not filled with it.
    crowd = spark.range(20_000).selectExpr("0L as vec_id", f"array({','.join(map(str, vectors[0]))}) as embedding")
    assert sorted(tuple(r) for r in ann.nearest_neighbours(table.union(crowd)).collect()) == once


# --- op8 --------------------------------------------------------------------------------------------


def test_like_notices_are_told_apart(spark):
    rows, want = [], {}
    for number, (label, text) in enumerate(licenses.NOTICES):
        words = licenses.notice_words(text)
        variants = [words]
        for at in range(1, len(words)):
            variants.append([*words[:at], "indeed", *words[at:]])
            variants.append([*words[:at], *words[at + 1 :]])
        for n, variant in enumerate(variants):
            rows.append((1000 * number + n, "before " + " ".join(variant) + " after", None))
            want[1000 * number + n] = label
    found = {r["doc_id"]: r["label"] for r in licenses.notice_spans(make_docs(spark, rows)).collect()}
    # What is left of a notice without its telling word may be another notice as it stands.
    texts = {i: t.removeprefix("before ").removesuffix(" after") for i, t, _ in rows}
    notices = {" ".join(licenses.notice_words(t)): label for label, t in licenses.NOTICES}
    for i, label in found.items():
        assert label == notices.get(texts[i], want[i]), texts[i]
    assert all(1000 * n in found for n in range(len(licenses.NOTICES)))
    several = make_docs(spark, [(1, ". ".join(t for _, t in licenses.NOTICES), None)])
    labels = {r["label"] for r in licenses.notice_spans(several).collect()}
    assert labels == {label for label, _ in licenses.NOTICES}


def test_only_letters_of_ascii_are_lowered(spark):
    row = licenses.scan_licenses(make_docs(spark, [(1, "MIT KLICENSE Mit License K", None)])).first()
    assert row["n_base"] == 1 and row["n_words"] == 5 and row["first_word"] == 2


# --- op5 --------------------------------------------------------------------------------------------


def plain_tree(pages):
    looks, blocks = collections.defaultdict(collections.Counter), collections.defaultdict(lambda: collections.defaultdict(list))
    for page in set(pages):
        for path, style, held in html_extract.page_styles(page):
            looks[path][style] += 1
            for block, times in held.items():
                blocks[path][block].append(times)

    def entropy(counts, m):
        total = sum(counts)
        return -sum(c / total * math.log(c / total) for c in counts) / math.log(m) if m > 1 else 0.0

    out, prior = {}, html_extract.PRIOR_PAGES
    for path, seen in looks.items():
        m = sum(seen.values())
        total = sum(sum(c) for c in blocks[path].values())
        content = sum(sum(c) * (1 - entropy(c, m)) for c in blocks[path].values()) / total if total else 1.0
        shown = entropy(seen.values(), m) if m > 1 else 1.0
        out[path] = [(x * m + prior) / (m + prior) for x in (shown, content)]
    return out


def test_importance_equals_a_plain_computation(spark):
    rng = np.random.default_rng(2)
    pool = [f"Offer {i} of the day" for i in range(5)]

    def page(i):
        items = "".join(f"<li>{x}</li>" for x in rng.choice(pool, 3))
        return f"<body><div><ul>{items}</ul></div><section><p>Story {'x' * i}</p>{'<h2>More</h2>' * (i % 3)}</section>"

    rows = [(i, "http://a.org/", page(i)) for i in range(25)] + [(90, "http://b.org/", page(0))]
    rows += [(i, url, html) for i, url, html in rows[:4]]
    schema = "key long, host string, path long, style long, blocks array<long>, times array<int>"
    base = spark.createDataFrame(rows, "id long, host string, html string").selectExpr("xxhash64(host, html) as key", "host", "html")
    styles = base.mapInPandas(html_extract._styles, schema).distinct()
    found = html_extract.style_tree(styles).collect()
    for host in ("http://a.org/", "http://b.org/"):
        want = plain_tree([h for _, u, h in rows if u == host])
        mine = {r["path"]: (r["shown"], r["held"]) for r in found if r["host"] == host}
        assert mine.keys() == want.keys()
        for path, pair in want.items():
            assert np.allclose(mine[path], pair)


def test_the_tree_alone_cleans_a_host(spark):
    """No article, no nav, no telling names; the menu varies a little from page to page."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(900)]
    pool = ["Home", "Sport", "Travel", "Food", "Money", "Weather 12", "Weather 14"]

    def page(i):
        menu = "".join(f"<div>{x}</div>" for x in rng.choice(pool, 5, replace=False))
        story = "".join(f"<p>{' '.join(rng.choice(words, 25))}</p>" for _ in range(4))
        return f"<html><body><div id=a>{menu}</div><div id=b><h2>{' '.join(rng.choice(words, 6))}</h2>{story}</div><div id=c>All rights</div></body></html>"

    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(40)]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in found:
        html = rows[r["page_id"]][2]
        assert r["text"].split("\n") == re.findall("<(?:h2|p)>(.*?)</", html)


def test_the_tree_alone_cleans_most_test_pages():
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["url", "html"]).to_pylist()
    hosts = collections.defaultdict(set)
    for row in table:
        hosts[(row["url"] or "").split("/")[2:3][0].lower()].add(row["html"] or "")
    off, gone, pages = html_extract.Rules(False, False, False), collections.Counter(), 0
    for of_host in sorted(hosts.items())[:12]:
        tree = {path: tuple(pair) for path, pair in plain_tree(of_host[1]).items()}
        for page in of_host[1]:
            pages += 1
            usual = html_extract.main_text(page, tree).split("\n")
            alone = html_extract.main_text(page, tree, off).split("\n")
            gone["whole"] += set(usual) <= set(alone)
            gone["advert"] += not any(x in alone for x in re.findall(r'class="ad">([^<]*)<', page))
            gone["menu"] += not any(x in alone for x in re.findall(r"<li><a[^>]*>([^<]*)<", page))
            gone["footer"] += not any(x.startswith("©") for x in alone)
    assert all(gone[x] > 0.6 * pages for x in ("advert", "menu", "footer")) and gone["whole"] > 0.95 * pages


@pytest.mark.parametrize(
    "branch",
    [
        '<article class="post comments-open"><p>Story</p></article>',
        '<main class="site-main no-sidebar"><p>Story</p></main>',
        '<div id="search-results"><p>Story</p></div>',
        '<div class="legal-notice"><p>Story</p></div>',
        '<div role="main" class="share-page"><p>Story</p></div>',
        '<article><p>Story</p></article><div class="comments"><article>A long reply to the story</article></div>',
        '<main><p>Story</p><div class="share">Tweet</div></main>',
    ],
)
def test_names_do_not_remove_the_article(branch):
    page = f"<html><body><nav>Menu</nav><div class='ad'>Buy</div>{branch}<footer>Us</footer></body></html>"
    assert html_extract.main_text(page, {}) == "Story"


def test_near_copies_on_a_host_keep_their_text(spark):
    common = "".join(f"<p>Paragraph {c} of the story that all copies share</p>" for c in "abcdefgh")
    page = "<html><body><div id=m>Menu</div><div id=s>{}<p>Only here {}</p></div></body></html>"
    rows = [(i, "http://h.org/", page.format(common, "x" * i)) for i in range(60)]
    long = "<html><body><p>" + "word " * 200_000 + "</p></body></html>"
    rows += [(99, "http://h.org/", long)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all("Paragraph a of" in found[i] and f"Only here {'x' * i}".strip() in found[i] for i in range(60))
    assert found[99] == " ".join(["word"] * 200_000)


# --- op9 and op10 -----------------------------------------------------------------------------------


def test_every_record_has_a_name_of_its_own(spark, tmp_path):
    rows = [(7, "http://x", "same page")] * 500 + [(i, None, "é" * 90_000 + str(i)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    folder, index = warc.write_archives(pages, str(tmp_path / "warc"))
    assert index.select("record_id").distinct().count() == len(rows)
    found = warc.read_archives(spark, folder, index)
    assert found.count() == len(rows) and found.where("body_bytes <> payload_bytes and record_type = 'response'").count() == 0
    # A record that is not where the index says is an error, not another page's text.
    from pyspark.errors import PySparkException

    wrong = index.withColumn("record_id", index["record_id"].substr(1, 20))
    with pytest.raises(PySparkException):
        warc.read_archives(spark, folder, wrong).collect()


def test_mixed_documents_carry_their_text(spark):
    rows = [(i, f"text {i}" * (5000 if i == 3 else 1), ["a", "b", None][i % 3]) for i in range(300)] + [(None, None, "a"), (None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs, mixing.source_rates(docs, exponent=0.5, epochs=3.0), seed=2)
    texts = {(i, s): t for i, t, s in rows}
    copies = collections.defaultdict(list)
    for r in mixed.collect():
        assert r["text"] == texts[r["doc_id"], r["source"]]
        copies[r["doc_id"], r["source"]].append(r["copy"])
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    steps = spark.range(1).select(mixing.poisson_steps(mixing.F.lit(1.7)).alias("s")).first()["s"]
    want = np.cumsum([math.exp(-1.7) * 1.7**k / math.factorial(k) for k in range(12)])
    assert np.allclose(steps[:12], want) and steps == sorted(steps)
