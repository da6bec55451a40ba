"""SimHash links, the prefix trie and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tallyspark.llm import kronecker_negatives, prefix_trie, simhash_bitslice
from tallyspark.llm.queries import LLM_ORACLE, LLM_QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import compare, duck  # noqa: E402

# ------------------------------------------------------------------ SimHash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(n, linked):
    comp = list(range(n))
    for i in range(n):
        for j in range(i):
            if comp[i] != comp[j] and linked(i, j):
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    return comp


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_fingerprint_of_any_length_and_piece(piece, monkeypatch):
    rng, whole = random.Random(piece), simhash_bitslice.pieces
    monkeypatch.setattr(simhash_bitslice, "pieces", lambda t: whole(t, piece))
    for n in (0, 1, 2, 3, 4, 300, 2000):
        text = rng.choice([" ", "\n\t", "\x0c"]).join(rng.choice(["Ab", "Été", "x" * 60, " ", "0"]) for _ in range(n))
        assert simhash_bitslice.fingerprint(memoryview(text.encode())) == plain_fingerprint(text), n


def test_sliced_pairs_are_all_pairs_within_the_radius():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = base + [x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for x in base for _ in range(6)]
    group = np.sort([rng.randrange(4) for _ in fps])
    got = set()
    for a, b in simhash_bitslice.sliced_pairs(np.array(fps, np.uint64), np.searchsorted(group, group, side="right")):
        got |= set(zip(a.tolist(), b.tolist(), strict=True))
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and (fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want and len(want) > 50


def test_last_level_is_bounded_and_every_level_keeps_every_pair():
    free = [64 - m.bit_count() for xs in simhash_bitslice.LEVELS[-1].values() for m in xs]
    assert 1 << max(free) <= simhash_bitslice.LEAF
    rng = random.Random(6)
    for _ in range(200):
        x, masks = sum(1 << b for b in rng.sample(range(64), rng.randrange(4))), [0]
        for level in simhash_bitslice.LEVELS:
            masks = [m for old in masks for m in level[old] if not x & m]
            assert masks  # a pair that differs in x meets under each of these


@pytest.mark.parametrize("leaf", [simhash_bitslice.LEAF, 3])
def test_simhash_components_with_edge_rows(make, leaf):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, "One\ttwo"), (None, "one two"), (None, "alone here")]
    for k in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([5, 60, 300]))]
        for copy in range(rng.randrange(1, 7)):
            new = list(text)
            for _ in range(rng.randrange(3)):
                new[rng.randrange(len(new))] = rng.choice(words)
            rows.append((100 + 10 * k + copy, " ".join(new)))
    got = simhash_bitslice.near_duplicates(make(rows), leaf=leaf).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = smallest_reachable(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    name = {c: min((d for (d, _), x in zip(rows, comp, strict=True) if x == c and d is not None), default=None) for c in comp}
    want = [(d, f"{f:016x}", name[c]) for (d, _), f, c in zip(rows, fps, comp, strict=True)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len(set(comp)) < len(rows) - 8


def test_simhash_of_an_empty_table(make):
    assert simhash_bitslice.near_duplicates(make([])).count() == 0


def test_dense_fingerprints_are_split_to_the_last_level(spark):
    """Fingerprints that share all but a few bits fill one bucket a level."""
    from tallyspark.llm.common import Stages, components

    rng = random.Random(9)
    fps = {sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 4, 5, 9) for _ in range(30)}
    fps = sorted(simhash_bitslice._signed(x) for x in fps)
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    stages = Stages(spark, "dense")
    got = {r.node: r.comp for r in components(simhash_bitslice.link(frame, stages, leaf=2), stages, "c").collect()}
    comp = smallest_reachable(len(fps), lambda i, j: ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 3)
    assert [got.get(x, x) for x in fps] == [fps[c] for c in comp]


# --------------------------------------------------------------- prefix trie

TURNS = "conv_id long, turn long, role string, text string, d long, k1 string, part string, n_leaves long"


def plain_trie(rows):
    convs = {}
    dig = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, dig(role or "", text or ""), role or "", text or ""))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    nodes = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        leaves = [q for q in below if not any(r[:-1] == q for r in nodes if r)]
        ends = ",".join(str(c) for c in sorted(c for c in members if tuple(full[c]) == p))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(1 for r in nodes if r and r[:-1] == p), len(leaves),
            sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def turns(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y", 3) for r in rows], TURNS)


def many_turns(rng):
    rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["éé", "b", "", None, "\U0001f600x"])) for c in rng.sample(range(0, 400), 70) for t in range(rng.randrange(1, 7))]
    rows += [(c, None, "user", "null turn") for c in (200, 201)] + [(None, 1, "user", "no conversation")]
    rows += [(c, 1, "user", "tie") for c in (300, 301, 301)] + [(301, 1, "assistant", "tie"), (-5, 1, "user", "b"), (-105, 1, "user", "b")]
    rows += [(100, t, "user", "b") for t in range(40)] + [(900 + c, 0, "user", "same") for c in range(60)]
    rows += [(7000 + c, t, "user", "x" * t) for c in range(3) for t in range(8)]  # no base
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force_with_small_blocks(spark, seed, monkeypatch):
    """Small windows, sibling blocks and a short local list, so that ranges,
    chunks, blocks and several levels of ranking are all passed."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "EVERY", 5)
    rows = many_turns(random.Random(seed))
    trie = prefix_trie.build_trie(turns(spark, rows).repartition(5), local=16)
    got = sorted((tuple(r) for r in prefix_trie.trie_report(trie).collect()), key=str)
    assert got == plain_trie(rows)
    nodes = trie.collect()
    # the tour: every position once, a node's arcs around its subtree's
    assert sorted(p for r in nodes for p in (r.enter_pos, r.exit_pos)) == list(range(2 * len(nodes)))
    for r in nodes:
        inside = [x for x in nodes if r.enter_pos < x.enter_pos < r.exit_pos]
        assert sum(x.parent_conv_id == r.conv_id and x.depth == r.depth + 1 for x in inside) == r.n_children
        assert len(inside) == (r.exit_pos - r.enter_pos - 1) // 2


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    assert prefix_trie.build_trie(turns(spark, [])).count() == 0
    lonely = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(lonely, 0, "user", "gone")]  # no base: the first turn falls away
    got = [tuple(r) for r in prefix_trie.trie_report(prefix_trie.build_trie(turns(spark, rows))).collect()]
    assert got == plain_trie(rows) and got[0][1] == 0 and got[0][5] == 1


def test_long_text_and_long_conversation(spark):
    rows = [(c, t, "user", "y" * (2_000_000 if t == 3 else 1)) for c in (0, 1) for t in range(30)]
    got = sorted((tuple(r) for r in prefix_trie.trie_report(prefix_trie.build_trie(turns(spark, rows))).collect()), key=str)
    assert got == plain_trie(rows)


# ------------------------------------------------------------ hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, rank int, rb int, positives string"


def plain_negatives(rows):
    best = {}
    for v, e, lab in rows:
        if v is None or lab is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        best[v] = min(best.get(v, (lab, e)), (lab, e))
    vecs = {v: ((lab + 1) % 10 if v % 7 == 0 else lab, [math.floor(256 * x) for x in e]) for v, (lab, e) in best.items()}
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    out = []
    for a in (v for v in vecs if v % 100 == 0):
        score = {v: clip(sum(x * y for x, y in zip(vecs[a][1], vecs[v][1], strict=False))) for v in vecs if v != a}
        order = sorted(score, key=lambda v: (-score[v], v))
        for p in [v for v in order if vecs[v][0] == vecs[a][0]][:5]:
            fit = [v for v in order if vecs[v][0] != vecs[a][0] and 80 * score[p] <= 100 * score[v] <= 100 * score[p]]
            out += [(a, p, k + 1, v, score[p], score[v]) for k, v in enumerate(fit[:5])]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(v, e, lab, 1, 2, "x") for v, e, lab in rows], VECTORS)


@pytest.mark.parametrize("low,high", [(-1, 1), (0, 3), (-1e7, 1e7), (-1e18, 1e18)])
def test_packed_products_are_exact(low, high):
    rng = random.Random(4)
    draw = lambda n: kronecker_negatives.scaled(pa.array([[rng.uniform(low, high) for _ in range(11)] for _ in range(n)]))
    rows, anchors = draw(60), draw(5)
    block = kronecker_negatives.Packed(rows, anchors)
    for a in anchors:
        want = [sum(int(x) * int(y) for x, y in zip(a, r, strict=True)) for r in rows]
        assert block.scores(a).tolist() == [min(max(w, -(2**63)), 2**63 - 1) for w in want]


def test_negatives_equal_brute_force_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(kronecker_negatives, "ROWS", 40)
    monkeypatch.setattr(kronecker_negatives, "ANCHORS", 2)
    rng = random.Random(12)
    axis = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(v, [x + rng.gauss(0, 0.2) for x in axis[rng.randrange(4)]], rng.randrange(4)) for v in range(0, 700, 2)]
    rows += [(v, list(axis[0]), v % 3) for v in range(1001, 1101)] + [(1100, list(axis[0]), 1)]  # ties
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [math.nan] * 6, 1), (2003, [math.inf] * 6, 1), (2004, axis[1], None), (None, axis[1], 1)]
    rows += [(2100, [], 1), (2101, axis[1][:3], 2), (2200, axis[2] + [5.0], 1), (2200, axis[2] + [5.0], 1), (2200, axis[1], 3), (-100, axis[3], 2), (-7, axis[3], 9)]
    got = kronecker_negatives.mine_negatives(vectors(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)
    assert len({r.anchor_id for r in got}) > 5


def test_negatives_with_huge_components_and_empty_table(spark):
    assert kronecker_negatives.mine_negatives(vectors(spark, [])).count() == 0
    rows = [(100, [1e30, 2.0], 1), (101, [1e30, 1.0], 1), (102, [1e30, 3.0], 2), (103, [0.5, -1.0], 2), (104, [-1e30, 0.0], 1)]
    got = kronecker_negatives.mine_negatives(vectors(spark, rows)).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_sql(spark, small_dir, name):
    r = compare(spark, name, LLM_QUERIES[name], LLM_ORACLE[name], small_dir, duck(small_dir))
    assert r["cols_match"] and r["types_match"] and r["hash_match"] and r["spark_rows"] == r["oracle_rows"], r
