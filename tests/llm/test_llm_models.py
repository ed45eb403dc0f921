"""Language ID, quality score, HTML text, top-k, codec and token counts."""

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokenloom.llm import bpe, html, language, quality, tokencount, topk
from tokenloom.llm.tables import read
from tokenloom.session import scratch_path

SF = "/root/testdata/sf0.001"
PATH = str(public_tokenizers.path(bpe.TOKENIZER))
CODEC = bpe.codec(open(PATH, encoding="utf-8").read())
LIBRARY = Tokenizer.from_file(PATH)


def test_forward_sums_all_segmentations():
    vocab = language.vocabulary()
    longest = max(map(len, vocab))
    assert longest > 16 and f"has {longest} bytes" in " ".join(language.__doc__.split())
    p = np.random.default_rng(1).dirichlet(np.ones(len(vocab)), 2).T
    place = {v: k for k, v in enumerate(vocab)}
    long_pieces = [v.decode().strip() for v in vocab if len(v) > 16]
    words = [w.encode() for w in ["the", "straße", "x" * 40, "ciónmente", "a", "漢字かな" * 30, "и" * 300, "the" * 3400] + long_pieces + [a + b for a, b in zip(long_pieces, long_pieces[1:])]]
    got = language.Scorer(tuple(vocab), p).score(words)
    for w, g in zip(words, got):
        w, scale = b" " + w, 0.0
        a = [1.0] + [0.0] * len(w)
        for j in range(1, len(w) + 1):
            a[j] = sum(a[i] * p[place[w[i:j]], 1] for i in range(max(0, j - longest), j) if w[i:j] in place)
            if a[j] < 1e-100:     # all values that are still looked at, scaled alike
                a[max(0, j - longest):j + 1] = [x * 1e100 for x in a[max(0, j - longest):j + 1]]
                scale += 100 * np.log(10)
        assert abs(g[1] - (np.log(a[-1]) - scale)) < 1e-9 * max(1, abs(g[1])), w[:40]


def test_language_held_out_accuracy_and_edges(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(900001, None, "en"), (900002, "123 !!", "de"), (900003, "the and of that " * 50, None), (None, "the that", "en"), (900004, "z" * 5000, "fr")],
                                "doc_id bigint, text string, lang string")
    rows = {r.doc_id: r for r in language.identify(docs.union(odd)).collect()}
    held = [r for i, r in rows.items() if r.held_out and i is not None and i < 900000]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert rows[900001].lang_pred == rows[900002].lang_pred == "und" and rows[900003].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows.values()) and rows[None].held_out is False
    assert [r.lang_pred for r in language.identify(odd.where("lang is null")).collect()] == ["und"]


def test_quality_held_out_accuracy_and_edges(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents").select("doc_id", "text"), read(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    odd = spark.createDataFrame([(900001, None), (900002, "")], "doc_id bigint, text string")
    out = quality.score(docs.union(odd), labels)
    held = out.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.label for r in held) / len(held) > 0.95
    assert {r.predicted for r in out.where("doc_id > 900000").collect()} <= {0, 1}
    plain = quality.score(odd, labels.limit(0)).collect()
    assert [r.score for r in plain] == [0.5, 0.5]


def test_html_text():
    page = """<html><head><title>t</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=/>Home</a></nav>
    <article><h1>Title &eacute;</h1><p><b>First  part<br>and <a href=x>link</a>.<p>Second paragraph, with enough words to be dense.
    <div class="comments"><p>A reader says more than the article itself, at length, again and again and again.</div></article>
    <aside>side</aside><form>q</form><div class="cookie-notice">We use cookies</div><footer>&copy; x"""
    assert html.main_text(page) == "Title é\nFirst part and link .\nSecond paragraph, with enough words to be dense.".replace("link .", "link.")
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p>") == ""
    assert html.main_text("plain &amp; simple") == "plain & simple"
    assert html.main_text("<div>" * 3000 + "x" + "</div>" * 3000) == "x"


@pytest.mark.parametrize("label", [
    'class="post type-post category-news tag-economy"', 'class="content has-sidebar"', 'class="with-sidebar"', 'class="col-side"', 'class="article-header"',
    'id="legal-news"', 'class="header"', 'data-id="menu" data-role="nav"', 'title=\' class="ad"\''])
def test_html_article_in_a_wrapper_with_a_label(label):
    text = "A long sentence of the article that goes on for a while, with enough words. " * 5
    page = f"""<body><div class="sidebar-left"><p>Elsewhere on this site</p></div><div {label}><h1>Title</h1><p>{text}</p><p>{text}</p>
    <div class="related-posts"><p>Another story</p></div><div class="comments"><p>{text * 9}</p></div></div><div class="ad">Buy</div></body>"""
    assert html.main_text(page) == "\n".join(["Title", text.strip(), text.strip()])
    small = f"<div><div {label}><h1>Title</h1></div><p>{text}</p><p>{text}</p></div>"   # here a whole name decides
    assert html.main_text(small) == "\n".join(["Title"] * (label != 'class="header"') + [text.strip()] * 2)


def test_html_hidden_is_an_attribute():
    text = "A long sentence of the article that goes on for a while, with enough words."
    page = f"""<article data-title="The hidden cost of x"><p title="A hidden gem">{text}</p><p data-x="display:none" alt='aria-hidden="true"'>{text}</p>
    <p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <button>press</button> it.</p>
    <p hidden>a</p><p HIDDEN="">b</p><p style="color:red; Display : none">c</p><p aria-hidden=true>d</p><button>Share</button></article>"""
    assert html.main_text(page) == f"{text}\n{text}\nLet x=2 and press it."


SENTENCE = "A long sentence of the article that goes on for a while, with enough words."


@pytest.mark.parametrize("page,want", [
    (f"<article><p title=it's>{SENTENCE} don't stop</p></article>", f"{SENTENCE} don't stop"),
    (f"<article><p title=its' x>{SENTENCE}</p></article>", SENTENCE),
    (f'<article><p title="x>{SENTENCE}</p></article>', SENTENCE),
    (f'<article><p title = "a > b" data-x=\'c > d\'>{SENTENCE}</p></article>', SENTENCE),
    (f"<article><p>{SENTENCE}<!-- a > b --><!--> 1 < 2 <</p></article>", f"{SENTENCE} 1 < 2 <"),
    (f"<body><div class=sidebar><p>{SENTENCE * 9}</p></div><article><p>{SENTENCE}</p><p>{SENTENCE}</p></article></body>", f"{SENTENCE}\n{SENTENCE}"),
    (f"<body><header>Site</header><article><header><h1>Headline</h1></header><p>{SENTENCE}</p><p>{SENTENCE}</p></article></body>", f"Headline\n{SENTENCE}\n{SENTENCE}")])
def test_html_tags_as_they_come(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("unit", ["<a ", '<a title="', "<a title='>' ", '<a title=">" b', "<!-- ", "</", "<script>", "<![", "<p x=' "])
def test_html_is_linear_in_what_is_left_open(unit):
    import time
    times = []
    for n in (10000, 40000):
        t0 = time.perf_counter()
        html.main_text(f"<p>{SENTENCE}</p>" + unit * n)
        times.append(time.perf_counter() - t0)
    assert times[1] < 12 * times[0] + 0.5


@pytest.mark.parametrize("opening", ["<div>", "<b>", "<blockquote><i>"])
def test_html_furniture_below_deep_nesting(opening):
    text = "A long sentence of the article that goes on for a while, with enough words."
    for n in (600, 50000):
        assert html.main_text(f"{opening * n}<p>{text}</p><nav>Home</nav><p hidden>gone</p><p>{text}</p>") == f"{text}\n{text}"


def test_html_keeps_whole_articles(spark):
    import re
    from html import unescape
    for r in html.extract(read(spark, SF, "pages")).join(read(spark, SF, "pages").select("page_id", F.col("html").alias("h")), "page_id").collect():
        body = r.h.split("<article>", 1)[1].split("</article>")[0]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_top_k_edges_and_ties(spark):
    rows = [(0, [1.0, 2.0]), (50, [1e30, 1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [3.0, 1.0, 1.0]),
            (5, [3.0, 1.0]), (5, [3.0, 1.0]), (None, [1.0, 1.0]), (100, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    top = (1 << 63) - 1
    assert got == [(0, 1, 50, top), (0, 2, 5, 327680), (0, 3, 5, 327680), (50, 1, 0, top), (50, 2, 5, top), (50, 3, 5, top)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_is_exact_over_many_shards(spark):
    v = np.random.default_rng(4).integers(-6, 7, (900, 5)) / 256.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, shard=100, block=4).collect()}
    whole = np.floor(256 * v).astype(int)
    for q in range(0, 900, 50):
        s = whole @ whole[q]
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, s[i]) for i in best]


def test_top_k_broadcasts_no_blocks(spark):
    v = np.random.default_rng(5).integers(-6, 7, (600, 4)) / 256.0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") % 3 == 0, shard=100, block=20)
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert len(found.collect()) == 200 * 5
    ran = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in ran and "Broadcast" not in planned + ran, ran
    shards = [pq.read_metadata(f.removeprefix("file://")) for f in found.inputFiles() if "/tokenloom-shards-" in f]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
    assert sum(m.num_rows for m in shards) == 6 and all(m.row_group(i).num_rows == 1 for m in shards for i in range(m.num_row_groups))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(["<|endoftext|>", " ", "\n", "the", "The", "'ll", "é", "　", "0", "\x1c", "aaaa"]), max_size=12).map("".join)))
def test_codec_equals_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(CODEC.encode(text), "<u4").tolist()
    assert got == want
    assert CODEC.decode(np.array(got, np.int64)) == LIBRARY.decode(want, skip_special_tokens=False)


def test_codec_long_words_and_edges(spark):
    for text in ("a" * 20000, "thethe" * 3000, "!?" * 5000):
        assert np.frombuffer(CODEC.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "x <|endoftext|> y", 7)], "doc_id bigint, text string, extra int")
    back = bpe.decode(bpe.encode(df, check=True)).orderBy("doc_id").collect()
    assert [(r.decoded, r.round_trip, r.extra) for r in back] == [("", True, 7), ("", True, 7), ("x <|endoftext|> y", True, 7)]
    assert bpe.encode(df.limit(0)).collect() == []


@pytest.mark.parametrize("block,stretch", [(997, 3), (1 << 20, 1024)])
def test_token_counts(spark, block, stretch):
    docs = read(spark, SF, "documents").select("doc_id", "text").union(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "a <|endoftext|> b"), (-4, "x"), (-4, "x")], "doc_id bigint, text string"))
    docs = docs.repartition(3).withColumn("n_ids", F.lit("clash")).withColumn("path", F.lit("clash"))
    files, owners = tokencount.write_token_files(docs, scratch_path(spark, "t"), file_ids=30000, id_col="doc_id")
    rows = tokencount.count_tokens(files.select("path", "n_ids"), block_ids=block, stretch=stretch).join(owners, ["path", "doc"]).collect()
    LIBRARY.encode_special_tokens = True
    want = sorted((r.doc_id, len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    LIBRARY.encode_special_tokens = False
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == want and all(r.closed for r in rows)
    by_file = {}
    for r in sorted(rows, key=lambda r: (r.path, r.doc)):
        assert (r.doc, r.first) == by_file.get(r.path, (0, 0))
        by_file[r.path] = (r.doc + 1, r.first + r.n_tokens + 1)
    none, _ = tokencount.write_token_files(docs.limit(0), scratch_path(spark, "t"))
    assert tokencount.count_tokens(none.select("path", "n_ids")).collect() == []


def test_token_counts_rerun_agrees_and_refuses_wide_ids(spark, monkeypatch):
    cols = ["doc_id", "file", "doc", "first", "n_tokens"]
    first, again = (sorted(map(tuple, tokencount.op3(spark, SF).select(*cols).collect())) for _ in range(2))
    assert first == again and len(first) == 200
    monkeypatch.setattr(tokencount, "WIDTH", 1)
    with pytest.raises(ValueError):
        tokencount.write_token_files(read(spark, SF, "documents"), scratch_path(spark, "t"))


def test_token_counts_foreign_files(spark, tmp_path):
    (tmp_path / "a.ids").write_bytes(np.array([1, 50256, 50256, 2, 3], "<u2").tobytes())
    (tmp_path / "empty.ids").write_bytes(b"")
    files = tokencount.files_of(spark, [str(tmp_path / "a.ids"), str(tmp_path / "empty.ids")])
    got = sorted((r.doc, r.first, r.n_tokens, r.closed) for r in tokencount.count_tokens(files, block_ids=2).collect())
    assert got == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 2, False)]
    (tmp_path / "odd.ids").write_bytes(b"abc")
    with pytest.raises(ValueError):
        tokencount.files_of(spark, [str(tmp_path / "odd.ids")])
