"""Large groups of near copies: results, and what is kept and moved of them."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_documents import edited, near_brute, prose

from tallyspark.llm import hamming_dedup
from tallyspark.llm.common import Stages


@pytest.fixture()
def near_copies():
    """Copies of one text of which about half are too far from all others."""
    rng = random.Random(11)
    base = prose(rng, 160)
    return [(i, edited(rng, base, 1 + i % 5)) for i in range(60)] + [(100, base), (101, base)]


def test_a_group_over_the_block_size_is_not_multiplied(spark, make, near_copies):
    written = {}

    class Counted(Stages):
        def write(self, df, name):
            out = super().write(df, name)
            written[name] = out.count()
            return out

    expect = near_brute(near_copies)
    got = hamming_dedup.near_duplicates(make(near_copies), Counted(spark, "large"), leaf=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expect
    alone = len(near_copies) - max(sum(c == x for _, x in expect.values()) for _, c in expect.values())
    assert alone > 20
    assert max(written.values()) <= len(near_copies) * hamming_dedup.SLOTS


def test_blocks_find_every_link_that_joins():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200, dtype=np.int64)
    sets = []
    for k in range(40):
        fresh = rng.integers(0, 2**63, k, dtype=np.int64)
        sets.append(np.unique(np.concatenate([rng.permutation(base)[len(fresh) :], fresh]).view(np.uint64)).view(np.int64))
    odd = hamming_dedup.parities(sets)
    flat = np.concatenate(sets).view(np.uint64)
    sig = hamming_dedup.signatures(flat, np.cumsum([0] + [len(x) for x in sets]))

    def links(sides):
        got = []
        for i, x in enumerate(sets):
            for j in range(i + 1, len(sets)):
                both = len(np.intersect1d(x, sets[j]))
                apart = len(x) + len(sets[j]) - 2 * both
                assert np.bitwise_count(odd[i] ^ odd[j]).sum() <= apart
                near = (sig[i] != sig[j]).sum() <= hamming_dedup.MAX_DIFF
                if near and (sides[i] != sides[j] or len(set(sides)) == 1):
                    if 100 * both >= hamming_dedup.PERCENT * (both + apart):
                        got.append((i, j))
        return got

    def parts(pairs):
        up = list(range(len(sets)))
        for a, b in pairs:
            up = [up[a] if x == up[b] else x for x in up]
        return {tuple(i for i, x in enumerate(up) if x == c) for c in up}

    for sides in ([0] * 40, [i % 2 for i in range(40)]):
        block = [(i, i, sig[i].tobytes(), sides[i], sets[i]) for i in range(40)]
        a, b = hamming_dedup.compare(block)
        assert parts(zip(a, b, strict=True)) == parts(links(sides)) and set(zip(a, b, strict=True)) <= set(links(sides))
        assert 3 < len(a) < 39
        # without the sets: what spans the pairs that the signatures leave
        rough = list(zip(*hamming_dedup.compare([(*r[:4], None) for r in block]), strict=True))
        assert len(rough) >= len(a) and len(rough) < 40
