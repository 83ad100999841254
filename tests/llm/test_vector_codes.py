"""Vector codes against plain integer rounds over all entries."""

import math

import numpy as np
import pytest

from tidewater.llm import vector_codes as vc
from tidewater.llm.registry import on_workers
from tidewater.operators import join_back

SCHEMA = "vec_id long, embedding array<float>, label int, code string, near int, rows string"


@pytest.fixture
def table(spark):
    on_workers(spark)

    def build(rows):
        return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return build


def brute(rows, parts=vc.PARTS, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], dtype=object).reshape(len(kept), parts, -1)
    books = [[list(x[k, p]) for k in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(p):
        return [min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), j)
                    for j, e in enumerate(books[p])) for v in x[:, p]]
    for _ in range(rounds):
        for p in range(parts):
            at = nearest(p)
            books[p] = [[sum(c) // len(own) for c in zip(*own, strict=True)]
                        if (own := [v for v, (_, j) in zip(x[:, p], at, strict=True) if j == k]) else e
                        for k, e in enumerate(books[p])]
    at = [nearest(p) for p in range(parts)]
    error = [sum(at[p][i][0] for p in range(parts)) for i in range(len(kept))]
    by_label = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        by_label[lab] = by_label.get(lab, 0) + e
    digest = vc.codebook_digest(np.array(books, dtype=object))
    return sorted(((i, "".join(f"{at[p][k][1]:02x}" for p in range(parts)), error[k], by_label[lab],
                    digest) for k, (i, _, lab) in enumerate(kept)), key=str)


def got(df):
    return sorted((tuple(r) for r in vc.vector_codes(df).collect()), key=str)


def drawn(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(24, dim))
    v = (centres[rng.integers(0, 24, n)] + rng.normal(size=(n, dim)) * 0.3) * spread
    return [(int(i), [float(c) for c in row.astype(np.float32)], int(i) % 3 if i % 5 else None)
            for i, row in zip(rng.permutation(n), v, strict=True)]


@pytest.mark.parametrize(("n", "dim", "spread"), [(400, 16, 1.0), (300, 24, 0.001), (10, 8, 1.0),
                                                  (200, 16, 20_000.0)])
def test_against_brute_force(table, n, dim, spread):
    rows = drawn(n, dim, n, spread)
    # ties, copies and repeated ids
    rows += [(i + n, v, lab) for i, v, lab in rows[:30]] + rows[:3] + [(None, rows[0][1], 7)]
    limit = vc.LIMIT / vc.SCALE
    rows = [(i, [max(-limit, min(limit, c)) for c in v], lab) for i, v, lab in rows]
    assert got(table(rows)) == brute(rows)


def test_rows_that_are_dropped_or_differ(table):
    rows = drawn(60, 16, 3)
    odd = [(100, None, 1), (101, [float("nan")] * 16, 1), (102, [1.0] * 15 + [None], 1),
           (103, [float("inf")] * 16, 1)]
    assert got(table(rows + odd)) == brute(rows)
    other = got(table([*rows, (104, [1.0, 2.0], 1)]))
    assert (104, None, None) in [r[:3] for r in other]
    assert sorted(r[:3] for r in other if r[1]) == sorted(r[:3] for r in brute(rows))


def test_no_rows_and_no_components(table):
    assert got(table([(1, None, 1)])) == []
    assert [r[:3] for r in got(table([(1, [], 1)]))] == [(1, "00" * 8, 0)]


def test_filled_dimension_and_huge_components(table):
    rows = [(i, [float(i % 4), 3e38 if i % 2 else -3e38, *[0.5] * 9], 1) for i in range(40)]
    filled = [(i, [max(-32768.0, min(32768.0, c)) for c in v] + [0.0] * 5, lab) for i, v, lab in rows]
    assert got(table(rows)) == brute(filled)


def test_bounds_spare_work_and_the_list_adapts(table):
    rows = drawn(600, 16, 5)
    _, _, log = vc.encode_vectors(table(rows))
    full = [r["looked"].get(vc.NONE, 0) / sum(r["looked"].values()) for r in log]
    assert full[0] == 1 and full[-1] < 0.6 and any(r["looked"].get(0, 0) for r in log[1:])
    assert vc.next_listed(4, {0: 50, vc.NONE: 50}) == 8
    assert vc.next_listed(8, {0: 990, 3: 10}) == 3 and vc.next_listed(8, {0: 1000}) == 2


def test_bounds_stay_right_while_entries_move():
    rng = np.random.default_rng(9)
    x = rng.integers(-500, 500, (300, 4))
    books = x[:16].copy()
    near, low = vc._listed(vc.squared_distances(x, books), 4)
    for b in (4, 8, 8, 3, 2, 6):
        new = books + rng.integers(-30, 30, books.shape)
        moved = np.sqrt(((new - books) ** 2).sum(1)) * (1 + 1e-12)
        near, low, _ = vc.reassign(x, new, moved, near, low, b)
        books = new
        d2 = vc.squared_distances(x, books)
        dist = np.sqrt(d2.astype(float))
        assert (near[:, 0] == d2.argmin(1)).all()
        assert (low[:, 0] >= dist.min(1)).all()
        for i in range(len(x)):
            for k in range(1, b + 1):
                later = [j for j in range(16) if j not in near[i, :k]]
                assert low[i, k] <= min(dist[i, later])


def test_join_back_with_hot_null_and_rare_keys(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i % 200) for i in range(1200)],
                                 "i long, k int")
    from pyspark.sql import functions as F
    sums = rows.groupBy("k").agg(F.sum("i").alias("total"), F.count("*").alias("n"))
    out = {r.i: r.total for r in join_back(rows, sums, ["k"], "n", F.xxhash64("i")).collect()}
    want = {}
    for i in range(1200):
        k = None if i % 3 == 0 else i % 200
        want[k] = want.get(k, 0) + i
    assert out == {i: want[None if i % 3 == 0 else i % 200] for i in range(1200)}
