"""Operators over pages, and the pipeline's stages."""

from __future__ import annotations

import random

from tallyspark.llm import crf_extract, url_cascade
from tallyspark.llm.common import Stages

PAGE = (
    "<html><head><title>t</title><script>if (a < b) x('</p>')</script></head><body><nav><ul><li><a href=/a>Home</a></ul></nav>"
    '<div class="ad">Buy &amp; go</div><article><h1>Big  title</h1><p>First <b>para</b>graph &eacute;.<p>Second&nbsp;one.'
    '<div class="comments"><p>Nice post.</p></div></article><footer>&copy; x</footer></body></html>'
)


def test_extraction_edge_pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<nav>x</nav>"), (4, "u", "<p>" * 50)]
    rows += [(10 + i, "u", PAGE.replace("Second", f"Other {i}")) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("x", "text")
    got = [(r.page_id, r.text, r.n_chars) for r in crf_extract.extract_main_text(pages).collect()]
    want = "Big title First paragraph é. Second one."
    assert got.count((1, want, len(want))) == 2
    assert {(2, "", 0), (3, "", 0), (None, "", 0), (4, "", 0)} <= set(got)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert crf_extract.extract_main_text(empty).count() == 0


def test_viterbi_is_the_best_labelling():
    rng = random.Random(1)
    blocks = [("text.", 0, (("p", frozenset()),))] * 6
    for _ in range(30):
        field = crf_extract.Field({"bias": rng.uniform(-1, 1)}, [[rng.uniform(-2, 2) for _ in range(2)] for _ in range(2)])
        s, t = field.scores(blocks), field.trans
        value = lambda y: sum(s[i] * k for i, k in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max(value([n >> i & 1 for i in range(6)]) for n in range(64))
        assert abs(value(field.viterbi(blocks)) - best) < 1e-9


def test_extraction_accuracy_on_marked_pages(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    got = {r.page_id: r.text for r in crf_extract.extract_main_text(pages).collect()}
    for r in pages.collect():
        blocks = crf_extract.leaf_blocks(r.html)
        marked = " ".join(b[0] for b, y in zip(blocks, crf_extract.own_labels(blocks), strict=True) if y)
        assert got[r.page_id] == marked


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(2)
    hosts = [(f"h{i}.example.net", rng.random() < 0.3) for i in range(3000)]
    frame = spark.createDataFrame(hosts, "host string, listed boolean")
    levels = url_cascade.build_cascade(frame, Stages(spark, "t"))
    assert len(levels) >= 2
    got = frame.withColumn("says", url_cascade.listed_by(frame.host, levels)).filter("says <> listed")
    assert got.count() == 0


def test_url_edge_rows(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.ORG/es/x?q#f"), (4, "http://my-casino.example.net?x"), (5, "s://org")]
    rows += [(6, "http://example.org/en/12"), (6, "http://example.org/en/12"), (None, "http://com/fr/"), (7, "x://notorg/"), (8, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_cascade.judge_urls(pages).collect()}
    assert got == {
        (1, "", "", None, "allow"),
        (2, "", "", None, "allow"),
        (3, "a.example.org", "/es/x", "example.org/es/", "block"),
        (4, "my-casino.example.net", "", None, "block"),
        (5, "org", "", None, "allow"),
        (6, "example.org", "/en/12", "example.org/en/1", "block"),
        (None, "com", "/fr/", "com/fr/", "allow"),
        (7, "notorg", "/", None, "allow"),
        (8, "", "", None, "allow"),
    }
    assert url_cascade.judge_urls(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, small_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        nxt = Stages(spark, "pipe").write(stage(spark, docs, small_dir), name)
        assert nxt.columns == docs.columns
        assert nxt.count() <= docs.count() and nxt.join(docs, docs.columns, "left_anti").filter("lang is not null").count() == 0
        docs = nxt
    texts = [r.text for r in docs.select("text").collect()]
    assert len(texts) == len(set(texts)) > 0
    items = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    assert not any(i in t for t in texts for i in items)
