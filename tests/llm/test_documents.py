"""Operators over documents against brute-force versions and edge rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from tallyspark.llm import (
    bench_decontam,
    exact_stream_dedup,
    feistel_pii,
    hamming_dedup,
    license_scan,
    mixture_langid,
    sp_sampling,
    suffix_dedup,
)
from tallyspark.llm.common import Stages, components

WORDS = [f"w{i}x" for i in range(400)]
EDGE = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, "one two"), (None, "three four five six seven"), (6, "é" * 3)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, k):
    words = text.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


# ------------------------------------------------------------- license scan


def test_license_edge_rows_and_fuzzy_spans(make):
    rows = EDGE + [
        (10, "All-Rights  reserved. CC BY x cc\tby"),
        (11, "text Released undr the MIT Licence end"),
        (12, "GNU Genral Public License and so on"),
    ]
    got = {(r.doc_id, r.labels, r.base_labels, r.n_base, r.first_word, r.last_word) for r in license_scan.license_report(license_scan.scan_licenses(make(rows))).collect()}
    assert (10, "cc-by,reserved", "cc-by,reserved", 3, 0, 6) in got
    assert (11, "mit", "", 0, None, None) in got
    assert (12, "gpl", "", 0, None, None) in got
    assert (1, "", "", 0, None, None) in got
    assert license_scan.license_report(license_scan.scan_licenses(make([]))).count() == 0


def test_license_seeds_find_all_that_a_plain_search_finds():
    rng, scanner = random.Random(3), license_scan.Scanner()
    for _ in range(150):
        notice, _, k = rng.choice(license_scan.NOTICES)
        chars = list(notice)
        for _ in range(rng.randrange(k + 2)):
            chars[rng.randrange(len(chars))] = rng.choice(["", "q", "zz"])
        norm = license_scan.normalise(prose(rng, 20) + " " + "".join(chars) + " " + prose(rng, 20))
        plain = {license_scan.NOTICES[i][1] for i, f in enumerate(scanner.fuzzy) if f.search(norm)}
        assert {s["label"] for s in scanner.spans(norm)} == plain


# -------------------------------------------------------------- exact dedup


def test_exact_dedup_edge_rows_and_weak_digest(make, spark):
    from pyspark.sql import functions as F

    rows = EDGE + [(20 + i, f"text {i % 4}") for i in range(12)]
    frame = make(rows)
    for digest in (None, lambda t: F.unhex(F.lit("00"))):
        got = exact_stream_dedup.exact_dedup(frame, digest).collect()
        assert len(got) == len(rows)
        groups = {}
        for d, t in rows:
            groups.setdefault(t or "", []).append(d)
        expect = sorted(
            (str(d), str(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for d, t in rows
        )
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expect
    assert exact_stream_dedup.exact_dedup(make([])).count() == 0


# --------------------------------------------------------------- pseudonyms


def test_pseudonyms_are_valid_linked_and_a_permutation(make):
    text = "pay 4041894974608795 from 44.161.181.40 or +1 (988) 555-2485 by 2024-02-29, a.b7@mail.example.com, 123-45-6789"
    rows = EDGE + [(30, text), (31, "again 4041894974608795!"), (32, "no 4041894974608796 nor 999.1.1.1")]
    got = {r.doc_id: r for r in feistel_pii.pseudonymise(make(rows)).collect()}
    assert got[1].text is None and got[1].n_found == 0
    assert got[30].kinds == "card,date,email,ip,phone,ssn"
    card = next(f.pseudonym for f in got[30].found if f.kind == "card")
    assert card in got[31].text and feistel_pii.luhn(card[:-1]) == int(card[-1])
    assert got[32].text == rows[-1][1] and got[32].n_found == 0
    for value in ("4041894974608795", "44.161.181.40", "555-2485", "a.b7@", "2024-02-29"):
        assert value not in got[30].text
    assert sorted(feistel_pii.permute(i, 1000, b"k", "t") for i in range(1000)) == list(range(1000))
    assert feistel_pii.pseudonymise(make([])).count() == 0


def test_phones_with_a_leading_0_or_1_are_replaced(make):
    values = ["+1 (017) 555-7713", "+1 (152) 555-8590", "988-055-2485", "110.155.2485"]
    rows = [(40 + i, f"call {v} or {v}, now") for i, v in enumerate(values)]
    got = {r.doc_id: r for r in feistel_pii.pseudonymise(make(rows)).collect()}
    for i, v in enumerate(values):
        r = got[40 + i]
        assert v not in r.text and r.kinds == "phone" and r.n_found == 2
        new = {f.pseudonym for f in r.found}
        assert len(new) == 1 and re.sub(r"\d", "0", new.pop()) == re.sub(r"\d", "0", v)
    many = [f"{a:03d}-{e:03d}-7713" for a in range(0, 1000, 7) for e in range(0, 1000, 7)]
    new = [feistel_pii.pseudonym("phone", v) for v in many]
    assert len(set(new)) == len(many)
    assigned = lambda v: v[0] not in "01" and v[4] not in "01"
    assert [assigned(v) for v in many] == [assigned(v) for v in new]


def test_values_inside_a_refused_match_and_cards_grouped_4_6_5(make):
    rows = [
        (50, "in 2024 4111 1111 1111 1111 was used"),
        (51, "2001-2024-4111-1111-1111-1111."),
        (52, "amex 3782 822463 10005 or 3782-822463-10005, not 3782 822463 10006"),
        (53, "2024 2024 4111 1111 1111 1112"),
    ]
    got = {r.doc_id: r for r in feistel_pii.pseudonymise(make(rows)).collect()}
    for i, head, tail in ((50, "in 2024 ", " was used"), (51, "2001-2024-", ".")):
        assert got[i].kinds == "card" and got[i].n_found == 1
        assert got[i].text.startswith(head) and got[i].text.endswith(tail) and "1111" not in got[i].text
        assert got[i].text[got[i].found[0].start : got[i].found[0].end] == got[i].found[0].pseudonym
    assert got[52].kinds == "card" and got[52].n_found == 2 and got[52].text.endswith("not 3782 822463 10006")
    one, two = (f.pseudonym for f in got[52].found)
    assert one.replace(" ", "-") == two and one != "3782 822463 10005" and feistel_pii.luhn(two.replace("-", "")[:-1]) == int(two[-1])
    assert got[53].text == rows[3][1] and got[53].n_found == 0


# --------------------------------------------------------------- near-dedup


def near_brute(rows):
    sets = {}
    for d, t in rows:
        if d is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_near_duplicates_match_brute_force(make):
    rng = random.Random(5)
    shared = prose(rng, 40)
    rows = list(EDGE)
    for g in range(4):
        base = prose(rng, 150)
        rows += [(100 * (g + 1) + i, edited(rng, base, rng.randrange(4))) for i in range(8)]
        rows += [(100 * (g + 1) + 50, base), (100 * (g + 1) + 51, base.upper())]
    rows += [(1000 + i, shared + " " + prose(rng, 30)) for i in range(12)]
    expect = near_brute(rows)
    for leaf in (2048, 3):  # the small leaf drives keys through every level
        got = hamming_dedup.near_duplicates(make(rows), leaf=leaf).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id) == expect[r.doc_id]
                assert r.kept == (r.doc_id == r.component_id)
    assert hamming_dedup.near_duplicates(make([])).count() == 0


def test_near_dedup_guarantee():
    c, m = hamming_dedup.CHUNKS, hamming_dedup.MAX_DIFF
    assert m <= 2 * (c - hamming_dedup.LEVELS + 1) - 1
    assert hamming_dedup.miss_probability() < 1e-5


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"), Stages(spark, "t"), "c").collect()
    assert {r.node: r.comp for r in got} == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert len(got) == len({r.node for r in got})


# ------------------------------------------------------------- suffix arrays


def test_suffix_ranks_and_windows():
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.integers(97, 99, 700), np.full(500, 97), rng.integers(97, 99, 50)]).astype(np.uint8)
    raw = data.tobytes()
    rank = suffix_dedup.suffix_ranks(data, 40)
    order = sorted(range(len(raw) - 40), key=lambda i: raw[i : i + 40])
    for a, b in zip(order, order[1:], strict=False):
        same = raw[a : a + 40] == raw[b : b + 40]
        assert rank[a] == rank[b] if same else rank[a] < rank[b]


def suffix_brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for s in range(len(t) - 399):
            seen[t[s : s + 400]] = seen.get(t[s : s + 400], 0) + 1
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        cov = [False] * len(t)
        for s in range(len(t) - 399):
            if seen[t[s : s + 400]] > 1:
                cov[s : s + 400] = [True] * 400
        runs = sum(c and (i == 0 or not cov[i - 1]) for i, c in enumerate(cov))
        out.append((str(d), len(t), sum(cov), runs, hashlib.sha256(bytes(x for x, c in zip(t, cov, strict=True) if not c)).hexdigest()))
    return sorted(out)


def test_suffix_dedup_matches_brute_force(make):
    rng = random.Random(9)
    passage, line = prose(rng, 120), prose(rng, 95)
    rows = EDGE + [(50 + i, prose(rng, 30) + passage + prose(rng, 40)) for i in range(6)]
    rows += [(60, "ab" * 900), (61, line + " é " + line), (62, prose(rng, 200)), (63, rows[-1][1]), (64, passage[:399]), (65, passage[7:420])]
    rows += [(66, prose(rng, 150))] * 2
    expect = suffix_brute(rows)
    for part in (2000, 2):  # the small part splits every anchor over shards
        got = suffix_dedup.remove_repeats(make(rows), part=part).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expect
    assert suffix_dedup.remove_repeats(make([])).count() == 0


def test_suffix_dedup_of_texts_under_a_null_doc_id(make):
    rng = random.Random(10)
    passage = prose(rng, 120)
    rows = [(None, prose(rng, 30) + passage + prose(rng, 40)), (70, prose(rng, 20) + passage), (None, prose(rng, 150))]
    got = suffix_dedup.remove_repeats(make(rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == suffix_brute(rows)
    assert sorted(r.n_removed > 0 for r in got) == [False, True, True]


# ------------------------------------------------------------- SentencePiece


def test_segmentations_round_trip_and_are_distinct(make):
    rows = EDGE + [(70, "Hello  world ▁ x\n\tEnd 😀 " + "zq" * 40), (71, "a b")]
    got = sp_sampling.sample_segmentations(make(rows), k=4)
    text = {d: t for d, t in rows}
    for r in sp_sampling.decode_segmentations(got).collect():
        assert r.text == (text[r.doc_id] or "")
    per = {}
    for r in got.collect():
        per.setdefault(r.doc_id, []).append((tuple(r.ids), r.sample))
        assert 0 <= r.inclusion <= 1 and r.log_prob <= 1e-9
    assert len(set(per[70])) == 4 and len({i for i, _ in per[70]}) == 4
    assert sp_sampling.sample_segmentations(make([])).count() == 0


def test_sampling_follows_the_lattice_distribution():
    """First samples are drawn with the segmentations' probabilities, and the
    inclusion-weighted sum of two estimates 1 (the sum of all)."""
    lattice = sp_sampling.Lattice(sp_sampling.MODEL)
    first, total, n = {}, 0.0, 4000
    for key in range(n):
        got = sp_sampling.sample(lattice, "than the", key, 2)
        first[tuple(got[0][0])] = first.get(tuple(got[0][0]), 0) + 1
        total += sum(np.exp(lp) / inc for _, lp, _, inc in got)
    probs = {tuple(ids): lp for key in range(200) for ids, lp, _, _ in sp_sampling.sample(lattice, "than the", key, 2)}
    for ids, c in first.items():
        if ids in probs and c > 40:
            p = np.exp(probs[ids])
            assert abs(c / n - p) < 5 * np.sqrt(p * (1 - p) / n)
    assert abs(total / n - 1) < 0.05


def brute_segmentations(lattice, text):
    """All segmentations of a text and their log-probabilities, by recursion
    over the pieces."""
    rank = {t: lattice.weight[i] for i, t in lattice.text.items()}
    ident = {t: i for i, t in lattice.text.items()}
    full = "\u2581" + text.replace(" ", "\u2581")

    def rest(at):
        if at == len(full):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, len(full) + 1):
            if full[at:end] in rank:
                out += [((ident[full[at:end]], *ids), rank[full[at:end]] + w) for ids, w in rest(end)]
        if full[at] not in rank:
            raw = full[at].encode()
            cost = lattice.byte_cost * len(raw)
            out += [((*(int(lattice.byte_ids[x]) for x in raw), *ids), cost + w) for ids, w in rest(at + 1)]
        return out

    got = rest(0)
    norm = np.logaddexp.reduce([w for _, w in got])
    return {ids: w - norm for ids, w in got}


def test_samples_match_the_enumerated_lattice():
    """Log-probabilities equal the enumeration's, and the second sample
    follows p / (1 - p of the first)."""
    lattice = sp_sampling.Lattice(sp_sampling.MODEL)
    for text in ("than", "a b", "\n\U0001f600x", "nested words"):
        every = brute_segmentations(lattice, text)
        assert abs(sum(np.exp(list(every.values()))) - 1) < 1e-9
        for key in range(20):
            for ids, lp, _, _ in sp_sampling.sample(lattice, text, key, 3):
                assert abs(every[tuple(ids)] - lp) < 1e-9
        assert len(sp_sampling.sample(lattice, text, 1, len(every) + 5)) == len(every)
    every, n, second, want = brute_segmentations(lattice, "than"), 6000, {}, {}
    for key in range(n):
        (one, p, _, _), (two, *_) = sp_sampling.sample(lattice, "than", key, 2)
        second[tuple(two)] = second.get(tuple(two), 0) + 1
    for a, pa_ in every.items():
        for b, pb in every.items():
            if a != b:
                want[b] = want.get(b, 0.0) + np.exp(pa_ + pb) / (1 - np.exp(pa_))
    for ids, p in want.items():
        assert abs(second.get(ids, 0) / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


def test_samples_do_not_depend_on_the_block():
    lattice = sp_sampling.Lattice(sp_sampling.MODEL)
    texts = ["than the", "", "x" * 300, "than the"]
    got = [[(ids.tolist(), lp) for ids, lp, _, _ in s] for s in sp_sampling.sample_texts(lattice, texts, [1, 2, 3, 1])]
    assert got[0] == got[3]
    for t, key, s in zip(texts, [1, 2, 3, 1], got, strict=True):
        alone = sp_sampling.sample(lattice, t, key)
        assert [x[0] for x in s] == [x[0] for x in alone]
        assert np.allclose([x[1] for x in s], [x[1] for x in alone])


# ---------------------------------------------------------- decontamination


def test_myers_distance_matches_dynamic_programming():
    rng = random.Random(4)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120)))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            nxt = [i]
            for j, d in enumerate(t, 1):
                nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (c != d)))
            row = nxt
        got = bench_decontam.myers(p, t, 10**6)
        assert (got[0] if got else len(p)) == min(min(row), len(p))


def test_decontamination_finds_edited_items(make, spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 25)) for i in range(6)] + [(90, None), (91, "short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = EDGE + [(200 + i, prose(rng, 60) + " " + t.upper() + "\n" + prose(rng, 30)) for i, t in items[:3]]
    chars = list(items[3][1])
    for at in (10, 60):
        chars[at] = "?"
    rows += [(210, prose(rng, 9) + " " + "".join(chars)), (211, prose(rng, 200))]
    for limit in (1 << 20, 200):  # the small limit makes a pass per item
        got = {(r.doc_id, r.item_id, r.edits) for r in bench_decontam.find_items(make(rows), bench, limit=limit).collect()}
        assert got == {(200, 0, 0), (201, 1, 0), (202, 2, 0), (210, 3, 2)}
        kept = {r.doc_id for r in bench_decontam.keep_clean(make(rows), bench, limit=limit).collect()}
        assert kept == {d for d, _ in rows} - {200, 201, 202, 210}
    assert bench_decontam.find_items(make([]), bench).count() == 0
    assert bench_decontam.find_items(make(rows), bench.limit(0)).count() == 0


def test_decontamination_finds_short_items(make, spark):
    han, kana = "中国的首都是哪座城市请选择正确答案" * 2 + "一二三四五", "日本でいちばん高い山はどれですか"
    items = [(1, "What is 2+2?"), (2, han), (3, kana), (4, "cat"), (5, " \n"), (6, ""), (7, "the Capital")]
    assert len(han) == 39
    rows = EDGE + [
        (300, "quiz: what  IS\n2+2? four"),
        (301, "前文" + han + "后文"),
        (302, "問題" + kana + "答え"),
        (303, "concatenate a cat."),
        (304, "concatenate cats, cat_a, cat\u0301 and scat"),
        (305, "What is 2+3? the capitals"),
        (306, "the\tcapital"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 10):
        got = {(r.doc_id, r.item_id): r for r in bench_decontam.find_items(make(rows), bench, limit=limit).collect()}
        assert set(got) == {(300, 1), (301, 2), (302, 3), (303, 4), (306, 7)}
        assert {r.edits for r in got.values()} == {0} and (got[303, 4].start, got[303, 4].end) == (14, 17)
        kept = {r.doc_id for r in bench_decontam.keep_clean(make(rows), bench, limit=limit).collect()}
        assert kept == {d for d, _ in EDGE} | {304, 305}


def test_windows_of_repetitive_items_are_not_cut():
    unit = "acb db acacb db acacb db acacb db acacb db acacb db acac"
    text = "x " * 30 + "acb qb acacb db acacb db acacb db acacb db acacb db acaq" + " y" * 30
    assert bench_decontam.myers(unit, text, 2)[0] == 2
    assert [h[:2] for h in bench_decontam.Matcher([(1, unit)], 0.05).find(text)] == [(1, 2)]
    rng, hits = random.Random(1), 0
    for _ in range(1500):
        unit = bench_decontam.normalise("".join(rng.choice("abcd ") for _ in range(rng.choice([5, 7, 10, 14]))) * 8)[: rng.randrange(45, 75)]
        if len(unit) < 40:
            continue
        most, chars = bench_decontam.budget(len(unit)), list(unit)
        for _ in range(most):
            chars[rng.randrange(len(chars))] = rng.choice(["", "q", "zz"])
        text = "x " * 30 + "".join(chars) + " y" * 30
        want = bench_decontam.myers(unit, text, most)
        assert [h[1] for h in bench_decontam.Matcher([(1, unit)], 0.05).find(text)] == ([want[0]] if want else [])
        scanner = license_scan.Scanner(((unit, "l", most),))
        assert bool(scanner.spans(text)) == bool(scanner.fuzzy[0].search(text))
        hits += want is not None
    assert hits > 100


# -------------------------------------------------------------- language ID


def test_language_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = mixture_langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    rows = got.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) > 0


def test_language_edge_rows_and_mixtures(make):
    a, b = ["alpha beta gamma delta " * 9, "ünder öber straße größe " * 9]
    rows = [(i, a if i % 2 else b, "x" if i % 2 else "y") for i in range(40)]
    rows += [(100, None, "x"), (101, "123 !", "x"), (102, "", None), (None, a, "x"), (103, a + b + b, None)]
    got = {r.doc_id: r for r in mixture_langid.identify(make(rows)).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[None].lang_pred == "x"
    assert got[103].lang_pred == "y" and {m.lang for m in got[103].languages} == {"x", "y"}
    assert got[None].held_out is False
    assert {r.lang_pred for r in mixture_langid.identify(make(EDGE)).collect()} == {"und"}
    assert mixture_langid.identify(make([])).count() == 0
    assert {r.doc_id for r in mixture_langid.keep_identified(make(rows)).collect()} == {r[0] for r in rows} - {100, 101, 102}
