import math
import random

import numpy as np
import pytest

from larder.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, n int, error string"


def brute(rows, parts=4, entries=256, rounds=4):
    """(vec_id, label, codes, error) and the codebooks, in plain Python integers."""
    fine = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not fine:
        return [], []
    length = len(fine[0][1])
    fine = [r for r in fine if len(r[1]) == length]
    cut = [i * length // parts for i in range(parts + 1)]
    books = [[r[1][a:b] for r in fine[:entries]] for a, b in zip(cut, cut[1:])]

    def assign(p, v):
        part = v[cut[p]:cut[p + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in fine:
                held.setdefault(assign(p, v)[1], []).append(v[cut[p]:cut[p + 1]])
            for i, members in held.items():
                books[p][i] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for i, v, lab in fine:
        found = [assign(p, v) for p in range(parts)]
        out.append((i, lab, tuple(c for _, c in found), sum(d for d, _ in found)))
    return out, books


def frame(spark, rows, slices=3):
    return spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in rows],
                                 SCHEMA).repartition(slices)


def vectors(seed, n, length, grid=None):
    pick = random.Random(seed)
    draw = (lambda: pick.choice(grid)) if grid else (lambda: pick.gauss(0, 0.1))
    return [(i, [float(np.float32(draw())) for _ in range(length)], pick.choice([0, 1, None]))
            for i in range(n)]


ODD = [(7, None, 1), (8, [1.0, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1),
       (9, [float("nan")] + [0.0] * 7, 2), (10, [float("inf")] + [0.0] * 7, 2),
       (None, [0.5] * 8, None), (3, [0.25] * 8, 5), (3, [0.25] * 8, 5), (2000, [1.0], 1)]


@pytest.mark.parametrize("rows, entries", [
    (vectors(1, 400, 8), 16),
    (vectors(2, 300, 8, [0.0, 0.5, -0.5]) + ODD, 16),     # ties, copies, nulls
    (vectors(3, 60, 10), 64),                             # 10 does not divide, few rows
    (vectors(4, 300, 4, [0.0, 1.0]), 256),                # entries that are equal
    (vectors(5, 90, 8) + [(500 + i, [0.125] * 8, 3) for i in range(200)], 16),
    (vectors(6, 40, 8, [100000.25, -100000.5]), 4),       # beyond exact doubles
])
def test_codes_equal_brute_force(spark, rows, entries, monkeypatch):
    monkeypatch.setattr(vector_codes, "LEAF", 8)
    codes, books = vector_codes.compressed(frame(spark, rows), entries=entries)
    want, want_books = brute(rows, entries=entries)
    assert [b.tolist() for b in books] == want_books
    got = sorted((str(r.vec_id), str(r.label), tuple(r.codes), r.error) for r in codes.collect())
    assert got == sorted((str(i), str(lab), c, e) for i, lab, c, e in want)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(9, 500, 8)
    want, _ = brute(rows, entries=32)
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    monkeypatch.setattr(vector_codes, "LEAF", 4)
    codes, _ = vector_codes.compressed(frame(spark, rows, 2), entries=32)
    assert sorted((r.vec_id, tuple(r.codes)) for r in codes.collect()) == sorted(
        (i, c) for i, _, c, _ in want)


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    """Far clusters leave nothing uncertain: no distance of a single part is computed."""
    pick = np.random.default_rng(0)
    centres = np.arange(8)[:, None] * np.full((1, 4), 100_000)
    points = (centres[:, None] + pick.integers(-9, 9, (8, 64, 4))).reshape(-1, 4)
    starts = vector_codes.leaf_starts(len(points), 32)
    order = vector_codes.tree_order(points, starts)
    monkeypatch.setattr(vector_codes, "distances", None)
    codes, sums, counts = vector_codes.nearest(
        points[order], starts, vector_codes.Codebook(centres))
    assert counts.tolist() == [64] * 8 and (codes == order // 64).all()
    assert (sums == points.reshape(8, 64, 4).sum(1)).all()


def test_empty_and_label_errors(spark):
    codes, books = vector_codes.compressed(frame(spark, vectors(1, 5, 4)).limit(0))
    assert books == [] and vector_codes.label_errors(codes).collect() == []
    rows = vectors(2, 100, 8)
    want, _ = brute(rows, entries=4)
    codes, _ = vector_codes.compressed(frame(spark, rows), entries=4)
    total = {}
    for _, lab, _, e in want:
        total[lab] = total.get(lab, 0) + e
    found = vector_codes.label_errors(codes).collect()
    assert len(found) == 100 and all(r.label_error == total[r.label] for r in found)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        vector_codes.compressed(frame(spark, [(1, [1e30] * 4, 1)]))[0].collect()
