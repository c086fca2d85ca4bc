"""Near duplicates against all pairs: many short texts around one line, and long pairs just above the threshold."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_joins_and_audits import frame, grams, linked_classes
from tillwatch.llm import near_dedup

SHAPE = near_dedup.HyperMinHash(percent=85)


def test_short_texts_around_one_line(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    line = " ".join(rng.choices(vocabulary, k=30))
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 8))) + " " + line + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(0, 3))) for _ in range(1200)]
    rows = list(enumerate(texts))
    got = near_dedup.near_duplicates(frame(spark, [(i, t, None, None) for i, t in rows]), SHAPE).collect()
    want = linked_classes(rows, 85)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == set(want)
    assert 1 < len({c for _, _, c in want}) < len(rows)
    assert sum(r.kept for r in got) == len({c for _, _, c in want})


def test_unlinked_variants_are_copied_once_and_compared_in_full(spark):
    """1,500 variants of one passage that hardly link: one copy of each in their bucket, small groups of whole texts."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        words = list(passage)
        for at in rng.sample(range(60), rng.choice((1, 2, 2, 2))):
            words[at] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    shape = near_dedup.HyperMinHash(percent=85, text_block=200)
    ids = spark.createDataFrame([(i,) for i, _ in rows], "node long")
    buckets = ids.selectExpr("1L as key", "node", "0L as centre")
    blocks = near_dedup._blocks(buckets, spark.createDataFrame([], "node long, root long"), ids, shape, fullest=False)
    assert blocks.count() == len(rows)
    got = near_dedup.near_duplicates(frame(spark, [(i, t, None, None) for i, t in rows]), shape).collect()
    want = linked_classes(rows, 85)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == set(want)
    assert 1 < len({c for _, _, c in want}) < len(rows)


def test_overlapping_buckets_become_one_and_keep_all_pairs(spark):
    """60 buckets with half of 200 nodes each, and small ones beside them: every pair still meets, in fewer rows."""
    rng = random.Random(6)
    buckets = {k: set(rng.sample(range(200), 100)) for k in range(60)}
    buckets |= {k: set(rng.sample(range(100, 1000), 5)) for k in range(60, 160)}
    ids = spark.createDataFrame([(i,) for i in range(1000)], "node long")
    rows = spark.createDataFrame([(k, i, 0) for k, nodes in buckets.items() for i in sorted(nodes)], "key long, node long, centre long")
    roots = spark.createDataFrame([], "node long, root long")
    blocks = near_dedup._blocks(rows, roots, ids, SHAPE, fullest=False).collect()

    def pairs(sets):
        return {(a, b) for nodes in sets for b in nodes for a in nodes if a < b}

    met = {}
    for r in blocks:
        met.setdefault(r.key, []).append(r.node)
    assert all(len(nodes) == len(set(nodes)) for nodes in met.values())
    assert pairs(buckets.values()) <= pairs(met.values())
    assert len(blocks) < 1000 + 6 * 100 < sum(map(len, buckets.values()))


@pytest.mark.parametrize("n_y", [0, 500])
def test_near_nodes_meet_once_in_small_groups(n_y):
    """All pairs of a group are near: each meets in exactly one group of at most two parts."""
    rng = np.random.default_rng(2)
    shape = near_dedup.HyperMinHash(percent=85, text_block=100)
    n = 350 + n_y
    one = rng.integers(0, 1 << 15, 256).astype(np.uint16)
    group = {
        "key": np.full(n, 7), "x": np.full(n, 3), "y": np.full(n, 5 if n_y else 3), "node": np.arange(n), "root": np.arange(n),
        "block": np.repeat([3, 5], [350, n_y]), "n_shingles": np.full(n, 300),
        "registers": np.tile(one, (n, 1)), "slots": np.zeros((n, near_dedup.SLOTS // 64), np.uint64),
    }
    near = near_dedup._near_of(shape)(group)
    met = Counter()
    for x, y in sorted({*zip(near["x"].tolist(), near["y"].tolist(), strict=True)}):
        inside = (near["x"] == x) & (near["y"] == y)
        part = {c: v[inside] for c, v in near.items()}
        order = np.lexsort((part["node"], part["block"]))
        part = {c: v[order] for c, v in part.items()}
        assert len(part["node"]) <= 200
        part |= {c: group[c][part["node"]] for c in ("n_shingles", "registers", "slots")}
        for i, at, _ in near_dedup._near_pairs(part, shape):
            met.update(tuple(sorted((int(part["node"][i]), int(part["node"][j])))) for j in at)
    want = {(a, b) for a in range(350) for b in range(350, n)} if n_y else {(a, b) for b in range(n) for a in range(b)}
    assert set(met) == want and set(met.values()) == {1}


def test_forest_of_parts_spans_what_all_pairs_span(monkeypatch):
    rng = np.random.default_rng(5)
    shape = near_dedup.HyperMinHash(percent=85)
    n = 120
    one = rng.integers(0, 1 << 15, 256).astype(np.uint16)
    registers = np.tile(one, (n, 1))
    for row in registers:
        row[rng.integers(0, 256, 30)] = rng.integers(0, 1 << 15, 30)
    group = {
        "key": np.full(n, 7), "x": np.zeros(n, int), "y": np.zeros(n, int), "node": np.arange(n), "root": np.arange(n), "block": np.zeros(n, int),
        "n_shingles": np.full(n, 300), "registers": registers, "slots": np.zeros((n, near_dedup.SLOTS // 64), np.uint64),
    }
    estimates = {(i, int(j)): e for i, at, similar in near_dedup._near_pairs(group, shape) for j, e in zip(at, similar, strict=True)}

    def weight(forest):
        return sum(estimates[pair] for pair in zip(forest["a"].tolist(), forest["b"].tolist(), strict=True))

    whole = near_dedup._forest_of(shape)(group)
    monkeypatch.setattr(near_dedup, "HELD_PAIRS", 50)
    parts = near_dedup._forest_of(shape)(group)
    assert len(whole["a"]) == len(parts["a"]) > n // 2
    assert weight(whole) == pytest.approx(weight(parts))


def just_above(rng: random.Random, n: int) -> tuple[str, str]:
    """Two texts of about n words whose similarity is 0.85 or barely more."""
    words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
    other = list(words)
    best = other
    for at in rng.sample(range(n), n):
        other = [*other[:at], f"x{rng.randrange(10**6)}", *other[at + 1 :]]
        a, b = grams(" ".join(words)), grams(" ".join(other))
        if 100 * len(a & b) < 85 * len(a | b):
            break
        best = other
    return " ".join(words), " ".join(best)


@pytest.mark.parametrize("sizes", [(110, 250), (250, 800)])
def test_no_long_pair_just_above_the_threshold_is_missed(spark, sizes):
    rng = random.Random(sizes[0])
    pairs = [just_above(rng, rng.randrange(*sizes)) for _ in range(250)]
    rows = [(2 * k + j, text, None, None) for k, pair in enumerate(pairs) for j, text in enumerate(pair)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), SHAPE).collect()}
    assert got == {i: i - i % 2 for i in range(len(rows))}
