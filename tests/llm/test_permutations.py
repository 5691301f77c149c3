from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import permutations

SCHEMA = "vec_id long, embedding array<float>, label int, node long, ids string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, "x", None) for i, v in rows], SCHEMA).repartition(3)


def vector(rng, dims=16, scale=1.0):
    v = np.array([rng.gauss(0, 1) for _ in range(dims)])
    return (v / np.linalg.norm(v) * scale).astype(np.float32).tolist()


def valid(rows):
    kept = [
        (i, v) for i, v in rows
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v) and len(v) == 16
    ]
    return list(dict.fromkeys((i, tuple(v)) for i, v in kept))


def brute(rows, neighbours=20):
    """{query_id: [(rank, vec_id, score)]} over all candidates."""
    rows, out = valid(rows), {}
    matrix = np.array([v for _, v in rows], np.float32).astype(np.float64)
    for i, v in rows:
        if i % 20 == 0:
            score = (matrix * np.array(v, np.float32).astype(np.float64)).sum(1)
            near = sorted((-s, j) for s, (j, _) in zip(score.tolist(), rows) if j != i)
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(near[:neighbours])]
    return out


def found(frame, **how):
    out = {}
    for r in sorted(permutations.search(frame, **how).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def odd_rows(rng):
    """Copies, ties, a hot vector, unusable and repeated rows."""
    hot, rows = vector(rng), []
    rows += [(i, vector(rng)) for i in range(150)]
    rows += [(200 + i, hot) for i in range(100)]
    for i in range(12):
        near = np.array(hot) + np.array(vector(rng)) * 0.01
        rows.append((400 + i, near.astype(np.float32).tolist()))
    rows += [(460, [1.0] + [0.0] * 15), (480, [-0.0] * 14 + [0.0, 2.0]), (480, [0.0] * 15 + [2.0])]
    rows += [
        (500, None), (520, []), (540, [0.0] * 16), (560, [math.nan] + [1.0] * 15), (580, [math.inf] + [1.0] * 15),
        (600, [None] + [1.0] * 15), (None, vector(rng)), (620, vector(rng, 5)), (0, rows[0][1]), (0, rows[0][1]),
    ]
    return rows


def test_everything_reranked_equals_brute_force(spark):
    rows = odd_rows(random.Random(1))
    got = found(frame(spark, rows), share=1.0, block_rows=60, query_rows=5, pivots=24, posted=12, probed=6)
    assert got == brute(rows)


def test_lengths_differ(spark):
    """Inner products, not angles: long vectors win."""
    rng = random.Random(2)
    rows = [(i, vector(rng, scale=rng.choice([0.5, 1, 3]))) for i in range(400)]
    got, want = found(frame(spark, rows), share=0.3, least=10, pivots=64, posted=32, probed=16), brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j, _ in got[q]} & {j for _, j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("dims", [16, 64])
def test_recall_with_production_parameters(spark, dims):
    """Random directions are the hardest case; every third vector lies in a group of near copies."""
    rng = np.random.default_rng(dims)
    plain = rng.standard_normal((4000, dims))
    group = rng.standard_normal((100, dims)).repeat(20, 0) + rng.standard_normal((2000, dims)) * 0.02
    all_rows = np.vstack([plain, group]).astype(np.float32)
    rows = [(i * 5, v.tolist()) for i, v in enumerate(all_rows)]
    got = found(frame(spark, rows))
    matrix = all_rows.astype(np.float64)
    hits = total = 0
    for q in list(got)[::10]:
        score = (matrix * matrix[q // 5]).sum(1)
        score[q // 5] = -np.inf
        want = {int(j) * 5 for j in np.argsort(-score)[:20]}
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert [s for _, _, s in got[q]] == [score[j // 5] for _, j, _ in got[q]]
        hits += len(want & {j for _, j, _ in got[q]})
        total += 20
    assert len(got) == 1500 and hits >= 0.9 * total


def test_few_and_no_vectors(spark):
    rng = random.Random(3)
    rows = [(20, vector(rng)), (21, vector(rng)), (22, vector(rng))]
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, rows[1:])) == {}
    assert found(frame(spark, rows[:1])) == {}
    assert found(frame(spark, [(20, None)])) == {} == found(frame(spark, rows).where("false"))
