"""Centroid clustering against plain arithmetic."""

import hashlib
import math
import random

import numpy as np

from gridloom.llm import hadamard


def brute(rows, count=16, rounds=3):
    kept = [(k, [math.floor(64 * float(x)) for x in v]) for k, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for i in range(len(centres)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == i]
            if own:
                centres[i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    sums = {i: sum(d for d, c in found if c == i) for i in range(len(centres))}
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((-1 if k is None else k, c, d, sums[c], sum(sums.values()), text[c]) for (k, _), (d, c) in zip(kept, found))


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], "x") for k, v in rows], "vec_id long, embedding array<float>, cluster string")


def clustered(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in hadamard.cluster(df).collect())


def test_against_plain_arithmetic(spark):
    draw = random.Random(1)
    middles = [[draw.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [float(np.float32(m + draw.gauss(0, 0.3))) for m in draw.choice(middles)]) for i in range(300)]
    rows += [rows[0], rows[0], (0, rows[5][1]), (None, rows[7][1]), (400, [0.0] * 64), (401, [-0.0078125] * 64)]
    rows += [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [math.nan] + [0.0] * 63), (505, [math.inf] + [0.0] * 63), (506, [None] + [0.0] * 63)]
    assert clustered(frame(spark, rows)) == brute(rows)


def test_few_none_and_equal_vectors(spark):
    few = [(i, [float(i)] * 64) for i in range(5)]
    assert clustered(frame(spark, few)) == brute(few)
    same = [(i, [0.25] * 64) for i in range(40)]
    got = clustered(frame(spark, same))
    assert got == brute(same) and {r[1] for r in got} == {0}
    empty = hadamard.cluster(frame(spark, few).limit(0))
    assert empty.count() == 0 and empty.columns == hadamard.cluster(frame(spark, few)).columns


def test_search_is_exact_with_ties_and_large_numbers():
    draw = np.random.default_rng(2)
    for high in (2, 50, hadamard.BOUND):
        vectors, centres = draw.integers(-high, high + 1, (500, 64)), draw.integers(-high, high + 1, (16, 64))
        centres[9] = centres[3]
        vectors[:50] = centres[draw.integers(0, 16, 50)]
        all_ = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
        number, distance = hadamard.nearest(vectors, centres)
        assert (number == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()


def test_components_beyond_the_bound_are_held(spark):
    rows = [(i, [3.0e38 * (-1) ** i] + [0.0] * 63) for i in range(3)]
    assert {r["distance"] for r in hadamard.cluster(frame(spark, rows)).collect()} == {0}


def test_transform_orders_coefficients_coarse_to_fine():
    t = hadamard.TRANSFORM
    assert (t @ t.T == 64 * np.eye(64)).all()
    assert [(r[1:] != r[:-1]).sum() for r in t] == list(range(64))
