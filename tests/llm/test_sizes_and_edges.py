"""What must not depend on the size of the table or on other columns."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
import regex

from tallyspark.llm import crf_extract, license_scan, mixture_langid, sp_sampling, suffix_dedup

WORDS = [f"w{i}x" for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# -------------------------------------------------------------- license scan


@pytest.mark.parametrize("text, spans", [
    ("all rihgts reserved all rights reserved", 2),
    ("all rights reserved all rihgts reserved", 2),
    ("x all rights resrved y all rights reserved z", 2),
    ("all rights reserved " * 40, 40),
    ("all rights reservedall rights reserved", 2),
    ("all rights re served all rigts reserved allrights reserved", 3),
    ("all", 0),
])
def test_every_span_of_a_notice_is_reported(text, spans):
    norm = license_scan.normalise(text)
    got = [s for s in license_scan.Scanner().spans(norm) if s["notice"] == "all rights reserved"]
    assert len(got) == spans
    for s in got:
        found = norm[s["start"] : s["end"]]
        m = regex.fullmatch(r"(?b)(?:all rights reserved){e<=2}", found)
        assert m and sum(m.fuzzy_counts) == s["edits"]
    ends = [(s["start"], s["end"]) for s in got]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_spans_and_base_places_against_a_plain_search():
    """Edited notices strewn apart: as many spans as were strewn, at their
    places; base places against all word positions."""
    rng, scanner = random.Random(11), license_scan.Scanner()
    for _ in range(60):
        notice, _, k = rng.choice(license_scan.NOTICES)
        text, places = "", []
        for _ in range(rng.randrange(1, 5)):
            chars = list(notice)
            for at in rng.sample(range(2, len(chars) - 2), rng.randrange(k + 1)):
                chars[at] = rng.choice(["", "q"])
            text += prose(rng, 12) + " "
            places.append(len(text))
            text += "".join(chars) + " "
        text += prose(rng, 5)
        n_words, base, spans = scanner.scan(text)
        got = [s["start"] for s in spans if s["notice"] == notice]
        assert len(got) == len(places) and all(abs(a - b) <= k for a, b in zip(got, places, strict=True)), (text, got, places)
        words = text.split()
        want = sorted((label, i) for phrase, label in license_scan.BASE_PHRASES.items()
                      for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
        assert sorted((b["label"], b["first"]) for b in base) == want and n_words == len(words)


# --------------------------------------------------------------- language ID


def test_threshold_takes_about_the_same_number_at_every_size():
    for n in (1, 199, 10_000, 10**7, 10**10, 2 * 10**10 + 1, 10**15):
        taken = n * (mixture_langid.threshold(n, 200) + 1) / 2**63
        assert taken >= min(n, 199) and taken <= max(n, 201) and (n <= 200 or taken < 201)


def test_a_rare_language_is_learned_beside_a_large_one(make):
    rng = random.Random(2)
    own = {"aa": "abcde", "bb": "vwxyz"}
    text = lambda lang: " ".join("".join(rng.choice(own[lang]) for _ in range(5)) for _ in range(30))
    rows = [(i, text("aa"), "aa") for i in range(3000)] + [(3000 + i, text("bb"), "bb") for i in range(20)]
    rows += [(5000, text("bb"), None), (5001, text("aa"), None), (5002, None, "aa"), (5003, "", "cc"), (5004, "123", None)]
    got = {r.doc_id: r.lang_pred for r in mixture_langid.identify(make(rows), max_train=300).collect()}
    assert [got[i] for i in (5000, 5001, 5002, 5003, 5004)] == ["bb", "aa", "und", "und", "und"]
    wrong = sum(got[d] != lang for d, t, lang in rows[:3020])
    assert wrong == 0


def test_labels_without_a_training_row_raise(make, monkeypatch):
    monkeypatch.setattr(mixture_langid, "threshold", lambda n, most: -1)
    with pytest.raises(ValueError, match="no training row"):
        mixture_langid.train(make([(1, "some text", "aa"), (2, "more text", "aa"), (3, "again", "aa"), (4, "text", "aa")]))


# ----------------------------------------------------------- HTML extraction

PAGES = "page_id long, url string, html string, text string, digest string"


def page(rng, marked):
    """(html, main text): menu, sentences in blocks, comments and a footer."""
    blocks = [prose(rng, rng.randrange(15, 60)).capitalize() + "." for _ in range(rng.randrange(1, 7))]
    body = "".join(f"<p>{b}</p>" for b in blocks)
    body = f"<article>{body}</article>" if marked else f"<div>{body}</div>"
    menu = "<nav><ul>" + "".join(f"<li><a href='/x'>{rng.choice(WORDS)}</a></li>" for _ in range(5)) + "</ul></nav>"
    tail = f"<div class='comments'><p>{prose(rng, 30).capitalize()}.</p></div><footer>{prose(rng, 20)}.</footer>"
    return f"<html><head><title>t</title></head><body>{menu}{body}{tail}</body></html>", " ".join(blocks)


@pytest.mark.parametrize("share", [1.0, 0.0, 0.5])
def test_main_text_with_and_without_marks(spark, share):
    rng = random.Random(5)
    known = [page(rng, rng.random() < share) for _ in range(80)]
    rows = [(i, f"u{i}", h, "x", "y") for i, (h, _) in enumerate(known)] + [(1000, None, None, "x", "y"), (None, "u", "", "x", "y"), (1, "u1", known[1][0], "x", "y")]
    got = crf_extract.extract_main_text(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    right = sum(texts[i] == t for i, (_, t) in enumerate(known))
    assert right >= 0.95 * len(known), right
    assert texts[1000] == "" and all(r.n_chars == len(r.text) for r in got)


def test_training_pages_are_bounded_and_the_longest_left_out(spark):
    rng = random.Random(6)
    rows = [(i, "u", page(rng, True)[0], "x", "y") for i in range(30)] + [(99, "u", "<article>" + "z" * 5000 + "</article>", "x", "y")]
    rows += [(7, "u", rows[7][2], "x", "y")] * 20  # repeated ids are one page
    frame = spark.createDataFrame(rows, PAGES).repartition(3)
    assert len(crf_extract.training_pages(frame, 12)) == 12
    assert len(crf_extract.training_pages(frame, 500, 4000)) == 30
    assert crf_extract.training_pages(frame.limit(0)) == []


# ------------------------------------------------- removal of repeated strings


def test_remaining_text_and_removed_runs(make):
    rng = random.Random(7)
    shared = "é" + prose(rng, 150)
    rows = [(i, f"{prose(rng, 20 + i)} {shared} {prose(rng, 30)}") for i in range(3)] + [(10, "short"), (11, None), (12, prose(rng, 200))]
    rows += [(13, rows[5][1])]  # a whole copy
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(make(rows)).collect()}
    for d, t in rows:
        raw, r = (t or "").encode(), got[d]
        kept = bytearray()
        at = 0
        for run in r.removed:
            kept += raw[at : run["start"]]
            at = run["end"]
        kept += raw[at:]
        assert hashlib.sha256(kept).hexdigest() == r.kept_sha256 and len(raw) - len(kept) == r.n_removed and len(r.removed) == r.n_spans
        assert r.text == kept.decode(errors="replace")
    assert got[0].n_removed > 500 and shared not in got[0].text and got[12].text == "" == got[13].text


# ------------------------------------------------------------ pipeline stages

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, sha string, keep long, own string, id long, whole string, tid long, n long, removed string, fp long, key long, most long"


def clashing(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1, "a", 2, "b", 3, "c", 4, 5, "d", 6, 7, 8) for d, t in rows], CLASHING)


def test_every_stage_takes_columns_of_any_name(spark, sf_small_benchmark):
    rng = random.Random(8)
    base = prose(rng, 80)
    rows = [(1, base), (2, base), (3, base + " tail"), (4, prose(rng, 50)), (5, None), (6, ""), (7, "12 34"), (4, prose(rng, 40)), (None, "no id here")]
    docs = clashing(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_small_benchmark)
        if name != "sentencepiece":
            assert out.columns == docs.columns, name
            kept = {(r.doc_id, r.text) for r in out.collect()}
            assert kept <= set(rows) and (4, rows[3][1]) in kept, name
            if name == "exact_dedup":
                assert (1, base) not in kept and (2, base) in kept
            if name == "near_dedup":
                assert not {(2, base), (3, base + " tail")} & kept
        assert stage(spark, docs.limit(0), sf_small_benchmark).count() == 0, name


@pytest.fixture()
def sf_small_benchmark(spark, tmp_path):
    spark.createDataFrame([(1, "a question that no document of these tests ever holds, for all they say")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


# ----------------------------------------------------- SentencePiece sampling


def test_long_stretches_are_summed_in_logarithms():
    """Texts whose plain sums leave the range of doubles give the same
    probabilities as short ones: every node's edges sum to one."""
    lattice = sp_sampling.Lattice.of(sp_sampling.MODEL)
    for text in ("a" * 3000, "ab" * 20 + " word", "漢字" * 400, "▁" * 50, "x" * 200 + " " * 300):
        graph = sp_sampling.Graph(lattice, [text, "plain words here"])
        total = np.add.reduceat(graph.p, graph.start[:-1])
        assert np.allclose(total, 1.0), text[:5]
        (ids, lp, _, inc), *rest = sp_sampling.sample(lattice, text, 3)
        assert lattice.decode(ids) == text and np.isfinite(lp) and 0 <= inc <= 1
