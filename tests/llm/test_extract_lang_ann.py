"""Extraction, language identification and vector search."""

from __future__ import annotations

import html
import random
import re
import string
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from lakestar.llm import ann, html_extract, lang_id, queries
from lakestar.llm.common import hash_sample

SF = "/root/testdata/sf0.01"
PAGE = "page_id bigint, url string, html string"


def page(body, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
            f"<nav><a href='/'>Home</a></nav>{before}<article>{body}</article>{after}<footer>&copy; site</footer></body></html>")


@pytest.fixture(scope="module")
def weights():
    draw = random.Random(1)
    prose = lambda: " ".join(draw.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(30))
    return html_extract.learn([page(f"<h1>A title</h1><p>{prose()}</p><p>{prose()}</p>", "<div class='ad'>Buy now</div>") for _ in range(20)])


def test_all_given_pages_give_their_article(spark):
    rows = {r.page_id: r for r in queries.op4_html_extract(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        expected = "\n".join(b for b in blocks if b)
        assert (rows[p.page_id].text, rows[p.page_id].n_chars, rows[p.page_id].url) == (expected, len(expected), p.url)


@pytest.mark.parametrize("names", [True, False])
def test_given_pages_without_their_marks(spark, names):
    """What the scan has learned tells adverts where neither an article nor a name does."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    weights = html_extract.learn(pages)
    for raw in pages:
        bare = raw.replace("<article>", "<div>").replace("</article>", "</div>")
        bare = bare if names else re.sub(r"""\s(class|id|role)=("[^"]*"|'[^']*')""", "", bare)
        assert html_extract.main_text(bare, weights) == html_extract.main_text(raw, weights) != ""


def test_furniture_inside_and_around_the_article_goes(weights):
    body = """<h1>Title &amp; more</h1><div class="share-buttons">Share me</div><p>One <b>bold</b>
      word&nbsp;here<br>next</p><aside><p>Related</p></aside><form><p>Sign up</p><input><button>Go</button></form><ul><li>item one</li><li>item&#32;two</li></ul>
      <div class="cookie-notice"><div><p>We use cookies</p></div></div><blockquote>A quote</blockquote><!-- <p>hidden</p> --><script>x("</article>")</script>
      <section id="comments"><article class="comment"><p>First!</p></article></section><p>Last</p>"""
    found = html_extract.main_text(page(body, "<div class='menu'>Menu</div><div id='sidebar'><p>Side</p></div>", "<div class='comments'><p>Nice</p></div>"), weights)
    assert found == "Title & more\nOne bold word here next\nitem one\nitem two\nA quote\nLast"


@pytest.mark.parametrize("around,inside", [
    ('<article class="post has-sidebar">%s</article>', ""), ('<article class="post comment-status-open">%s</article>', ""),
    ('<div class="content-sidebar-wrap"><article>%s</article></div>', ""), ('<div class="page header-fixed"><article>%s</article></div>', ""),
    ('<div class="page header-fixed">%s</div>', ""), ('<article data-id="ad" title="class=ad">%s</article>', ""), ('<article>%s</article>', '<h2 id="related-work">More</h2>'),
    ('<article>%s</article>', '<h2 id="search">More</h2>'), ('<article>%s</article>', '<h3 class="header">More</h3>'), ('<article>%s</article>', '<p class="alert-level">More</p>'),
    ('<article>%s</article>', '<section id="related-work"><p>More</p></section>'), ('<article>%s</article>', '<div data-id="share">More</div>'),
])
def test_names_that_are_no_furniture_cost_nothing(weights, around, inside):
    text = " ".join(["word"] * 30)
    body = f"<p>{text}</p>{inside}<p>{text}</p>"
    raw = f"<html><body><nav>Home</nav><div class='sidebar'><p>Side</p></div>{around % body}<div id='comments'><p>Nice</p></div></body></html>"
    assert html_extract.main_text(raw, weights) == "\n".join([text, *["More"] * bool(inside), text])


def test_long_threads_and_marked_paragraphs_go(weights):
    thread = "<div class='comments'>%s</div>" % ("<article class='comment'><p>I say so too</p></article>" * 100)
    assert html_extract.main_text(page("<p>One</p><p class='ad'>Buy<p>Two</p><div class='share'><p>x<p>y</div>" + thread, "", thread), weights) == "One\nTwo"


def test_plain_boxes_around_the_article_lose(weights):
    text = " ".join(["word"] * 60)
    found = html_extract.main_text(page(f"<p>{text}</p>", "<div>About us</div>", "<div>Read more here</div>"), weights)
    assert found == text


@pytest.mark.parametrize("raw,expected", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a\nb"), ("<div><p>open <i>tags", "open tags"),
    ("</p></div>stray", "stray"), ("a < b and c > d", "a < b and c > d"), ("<nav>only a menu</nav>", ""), ("<script>never closed", ""), ("<p>x</p><!-- open", "x"),
])
def test_broken_markup(raw, expected):
    assert html_extract.main_text(raw, html_extract.Weights({}, {}, 1.0)) == expected


@pytest.mark.parametrize("unit", ["<a ", "<b>x", "<p>x", "<div class='ad'>x", "<a href='", '<a "', "<!-- ", "<!", "< ", "</b>", "<script>", "<div><p>x", "<!--x--", "&amp;<i ", "<title>x"])
def test_broken_pages_take_time_in_proportion(unit):
    raw = unit * (1_000_000 // len(unit))
    began = time.process_time()
    html_extract.main_text(raw, html_extract.Weights({}, {}, 1.0))
    assert time.process_time() - began < 12


def test_quotes_that_never_close():
    weights = html_extract.Weights({}, {}, 1.0)
    assert html_extract.main_text("<p title='a>b'>one</p><p title='open>two</p>", weights) == "one\ntwo"
    assert html_extract.main_text('<a title="x > y">in</a> <a b', weights) == "in <a b"


def test_the_region_is_the_best_of_all():
    draw = random.Random(7)
    for _ in range(300):
        scores = [draw.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(draw.randint(0, 12))]
        a, b = html_extract.best_region(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(best, 0)


def test_extraction_odd_tables(spark):
    weights = html_extract.fit(spark.createDataFrame([], PAGE))
    assert weights == html_extract.Weights({}, {}, 1.0)
    df = spark.createDataFrame([(1, None, None, 5, "x"), (2, "u", "<p>é</p>" + "<p>w</p>" * 50_000, 5, "x"), (2, "u", "<p>é</p>", 5, "x")], PAGE + ", TEXT int, main_text string")
    rows = html_extract.extract(df, html_extract.Weights({"p": 1.0}, {"p": -0.01, "/p": -0.01}, 1.0)).collect()
    assert [(r["text"], r["n_chars"]) for r in rows if r.page_id == 1] == [("", 0)] and rows[1]["n_chars"] == 1 + 2 * 50_000
    assert rows[2]["text"] == "é" and rows[0]["main_text"] == "x"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    told = queries.op8_language_id(spark, "/root/testdata/sf0.1").collect()
    assert len(told) == len(docs)
    held = [r for r in told if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in told if r.held_out} == {r.doc_id for r in held}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.985 * len(held)
    assert all(0 <= r.score <= 1 for r in told) and sum(r.rejected for r in told) <= 0.01 * len(told)


def test_learning_takes_only_labels_of_the_other_folds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = lang_id.fit(docs.where(~queries.held_out()))
    scrambled = docs.withColumn("lang", F.when(queries.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert lang_id.fit(scrambled.where(~queries.held_out())) == known and "xx" not in known
    assert all(len(v) <= lang_id.DICTIONARY_BYTES for v in known.values())


LANG = "doc_id bigint, text string, lang string"


def told_by_hand(text, model):
    """Language and margin by compressing the whole text with every dictionary, one block after another."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    bare = "".join(c for c in text.lower() if c not in string.punctuation + string.digits)
    data = b" " + b" ".join(bare.encode().split()) + b" "
    totals = {}
    for lang, content in model.items():
        size = 0
        for at in range(0, len(data), lang_id.BLOCK_BYTES):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=zstandard.ZstdCompressionParameters(**lang_id.PARAMETERS))
            coder = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters(**lang_id.PARAMETERS), dict_data=known)
            size += len(coder.compress(data[at:at + lang_id.BLOCK_BYTES]))
        totals[lang] = size
    first, second = sorted(totals.items(), key=lambda x: (x[1], x[0]))[:2]
    return first[0], (second[1] - first[1]) / second[1]


def test_languages_equal_compression_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lang_id.fit(docs)
    rows = lang_id.identify(docs.select("doc_id", "text"), model).where("length(text) < 6000").collect()
    assert len(rows) > 100
    for r in rows[:120]:
        lang, score = told_by_hand(r.text, model)
        assert (r.lang_pred, r.rejected) == (lang, lang == "und" or score < 0.005) and r.score == pytest.approx(score)


def test_the_number_of_languages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "MAX_LANGUAGES", 2)
    rows = [(i, f"text number {chr(97 + i)} of one", "aa") for i in range(5)] + [(9, "same", "bb")] * 50 + [(10, "one", "cc"), (11, "two", "cc"), (12, "x", "zz")]
    assert set(lang_id.fit(spark.createDataFrame(rows, LANG))) == {"aa", "cc"}


def test_language_odd_rows(spark):
    train = spark.createDataFrame([(1, "the cat and the dog are in the house", "en"), (2, "le chat et le chien sont dans la maison", "fr"),
                                   (3, None, "de"), (4, "unlabelled words", None), (5, "12 34", "nn")], LANG)
    model = lang_id.fit(train)
    assert set(model) == {"en", "fr"}
    rows = [(1, None, None), (2, "", None), (3, "123 !!", None), (4, "the dog and the cat", None), (5, "LE CHIEN ET LE CHAT", None), (5, "LE CHIEN ET LE CHAT", None),
            (6, "the cat and the dog " * 30_000, None), (7, "日本", None)]
    df = spark.createDataFrame([(*r, 0, "told") for r in rows], LANG + ", SCORE int, told_language string")
    got = lang_id.identify(df, model).collect()
    assert [r.lang_pred for r in got if r.doc_id < 7] == ["und", "und", "und", "en", "fr", "fr", "en"]
    assert all(r.score == 0 and r.rejected for r in got if r.doc_id < 4) and got[0].told_language == "told"
    assert lang_id.identify(spark.createDataFrame([], LANG), model).collect() == []
    none = lang_id.identify(spark.createDataFrame(rows, LANG), {}).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = lang_id.identify(spark.createDataFrame(rows, LANG), {"en": model["en"]}).where("doc_id = 4").first()
    assert (one.lang_pred, one.score, one.rejected) == ("en", 1.0, False)


def test_copies_do_not_thin_the_sample_of_a_language(spark):
    others = [(i, f"parole{chr(97 + i % 26)}{chr(97 + i // 26)} della casa", "it") for i in range(100)]
    copies = spark.range(60_000).selectExpr("id as doc_id", "'una copia sola' as text", "'it' as lang")
    model = lang_id.fit(copies.unionByName(spark.createDataFrame(others, LANG)))
    assert sorted(model["it"].split(b" ")) == sorted(" ".join(["una copia sola", *[x[1] for x in others]]).encode().split(b" "))


VEC = "vec_id bigint, embedding array<float>"


def brute_nearest(vectors, k):
    out = {}
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], dtype=np.float64)
    for i in ids[ids % 20 == 0]:
        scores = matrix @ np.array(vectors[i], dtype=np.float64)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), scores[j]) for j in order]
    return out


def found(spark, rows, k=20):
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, VEC), F.col("id") % 20 == 0, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()}


@pytest.mark.parametrize("queries_", [1 << 15, 60])
def test_recall_against_brute_force(spark, monkeypatch, queries_):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    monkeypatch.setattr(ann, "OBJECTS", 1500)  # several blocks
    monkeypatch.setattr(ann, "QUERIES", queries_)
    got, want = found(spark, rows), brute_nearest(dict(rows), 20)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows}
    assert all(abs(s - vectors[q] @ vectors[v]) < 1e-9 for q, x in got.items() for v, s in x)


def test_rows_to_rank_and_blocks_held_do_not_grow_with_the_table(spark, monkeypatch):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    made = []
    search = ann._search

    def counted(*args):
        sizes = spark.sparkContext.accumulator(0)
        made.append(sizes)

        def count(batches):
            for batch in search(*args)(batches):
                sizes.add(batch.num_rows)
                yield batch
        return count

    monkeypatch.setattr(ann, "_search", counted)
    vectors = np.random.RandomState(6).randn(10000, 8).tolist()
    for n in (2000, 10000):
        found(spark, list(enumerate(vectors[:n])))
    a, b = (x.value for x in made)
    assert 0 < b <= 1.2 * 5 * a  # 25 times as many, when the number of blocks grew with the table
    monkeypatch.setattr(ann, "_search", search)
    monkeypatch.setattr(ann, "OBJECTS", 30)  # several blocks of each stripe
    monkeypatch.setattr(ann, "QUERIES", 60)
    got, want = found(spark, given), brute_nearest(dict(given), 20)
    assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.95 * 20 * len(want)


def test_cells_are_cut_at_any_batch():
    rows = [(c, o, i) for c in (0, 1, 4) for o, n in ((False, 3), (True, 8 if c else 0)) for i in range(n)]
    table = pa.table({name: [r[j] for r in rows] for j, name in enumerate(("cell", "is_object", "id"))})
    for size in (1, 2, 5, 100):
        cut = [(int(c), bool(o), t["id"].to_pylist()) for c, o, t in ann.by_cell(iter(table.to_batches(max_chunksize=size)), 3)]
        assert cut == [(0, False, [0, 1, 2])] + [x for c in (1, 4) for x in ((c, False, [0, 1, 2]), (c, True, [0, 1, 2]), (c, True, [3, 4, 5]), (c, True, [6, 7]))]


@pytest.mark.parametrize("kind", ["lognormal", "few long"])
def test_recall_with_unequal_lengths(spark, kind):
    draw = np.random.RandomState(5)
    vectors = draw.randn(4000, 64)
    length = np.exp(0.5 * draw.randn(4000)) if kind == "lognormal" else np.where(draw.rand(4000) < 0.05, 3.0, 1.0)
    vectors *= (length / np.linalg.norm(vectors, axis=1))[:, None]
    rows = [(i, x) for i, x in enumerate(vectors.astype(np.float32).tolist())]
    got, want = found(spark, rows), brute_nearest(dict(rows), 20)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)


def test_small_tables_are_exact_with_ties_to_the_smaller_id(spark):
    draw = np.random.RandomState(3)
    rows = [(i, draw.randn(8).round(1).tolist()) for i in range(60)] + [(i, [1.0] * 8) for i in range(60, 200)]
    got, want = found(spark, rows), brute_nearest(dict(rows), 20)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}
    few = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.1, 0.9])]
    assert {q: len(x) for q, x in found(spark, few).items()} == {0: 2, 20: 2}


def test_samples_of_repeated_values_hold_all_of_them(spark):
    few = spark.range(100_000).selectExpr("concat('value ', id % 10) as v")
    assert sorted(hash_sample(few, "v", 256)) == [f"value {i}" for i in range(10)]
    equal = spark.range(5_000).selectExpr("id as vec_id", "array(3.0f, 4.0f, 5.0f) as embedding")
    rows = ann.nearest(equal, F.col("id") == 0, 20).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(i, 50.0) for i in range(1, 21)]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (7, [3.0, 1.0]),
            (8, [1.0, 2.0, 3.0]), (7, [3.0, 1.0]), (20, [nan, 1.0])]
    assert found(spark, rows) == {0: [(7, 5.0)]}
    assert found(spark, []) == {} and found(spark, [(0, [1.0])]) == {}
    df = spark.createDataFrame([(0, [1.0], 5, "x"), (1, [2.0], 6, "y")], VEC + ", id int, near string")
    assert ann.nearest(df, F.col("id") % 20 == 0, 5).collect()[0].vec_id == 1


def test_footrule_of_inverted_files():
    draw = np.random.RandomState(4)
    pivots, k = 12, 5
    near = np.array([draw.permutation(pivots)[:k] for _ in range(40)], dtype=np.uint16)
    files = ann.inverted_files(near, pivots)
    place = np.full((40, pivots), k)
    for i, order in enumerate(near):
        place[i, order] = np.arange(k)
    for q in range(5):
        common = ann.common_places(files, near[q]).astype(int)
        assert (k * (k + 1) - 2 * common == np.abs(place - place[q]).sum(axis=1)).all()
