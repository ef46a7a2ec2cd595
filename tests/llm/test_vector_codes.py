import hashlib
import math

import numpy as np
import pytest

from patronage.llm import queries
from patronage.llm import vector_codes as vc
from tests.compare import assert_same, connect

ROWS = "vec_id long, embedding array<double>, label int, code string, error long, vec_ids int"


def brute(rows, how):
    """By plain loops over Python's integers."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    size = len(kept[0][1]) // how.parts
    cut = [[[math.floor(how.scale * x) for x in v[p * size : (p + 1) * size]] for p in range(how.parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[: how.entries]] for p in range(how.parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def best(part, p):
        ds = [distance(part, c) for c in books[p]]
        return ds.index(min(ds)), min(ds)

    for _ in range(how.rounds):
        for p in range(how.parts):
            own = [best(row[p], p)[0] for row in cut]
            for k in range(len(books[p])):
                members = [row[p] for row, o in zip(cut, own, strict=True) if o == k]
                books[p][k] = [sum(col) // len(members) for col in zip(*members, strict=True)] if members else books[p][k]
    found = [[best(row[p], p) for p in range(how.parts)] for row in cut]
    errors = [sum(d for _, d in f) for f in found]
    totals = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        totals[label] = totals.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    coded = zip(kept, found, errors, strict=True)
    return sorted(((i, "".join(f"{k:02x}" for k, _ in f), e, totals[label], digest) for (i, _, label), f, e in coded), key=str)


def result(spark, rows, how):
    frame = spark.createDataFrame([(i, v, label, "x", -1, -1) for i, v, label in rows], ROWS)
    return sorted((tuple(r) for r in vc.compress(frame, how).collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_same(queries.op13_vector_codes(spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), queries.ORACLE["op13_vector_codes"])


def test_products_are_exact_over_several_limbs():
    rng = np.random.default_rng(0)
    for bits in (3, 20, 24, 25, 28, 29):
        a, b = (rng.integers(-(1 << bits), 1 << bits, (40, 8)) for _ in range(2))
        a[0], b[0] = -(1 << bits), (1 << bits) - 1
        want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
        assert vc.exact_products(a, b).tolist() == want
        width = (53 - (8).bit_length()) // 2
        split = vc.limbs(a, width)
        assert len(split) == (1 if bits <= width else 2) and max(np.abs(x).max() for x in split) * 2**width * 8 <= 2**53
    assert vc.exact_products(np.zeros((0, 8), int), np.ones((2, 8), int)).shape == (0, 2)


def test_first_of_equally_near_entries_wins():
    best, distance = vc.nearest(np.array([[0, 0], [5, 5]]), np.array([[3, 4], [-3, 4], [4, 3], [5, 5], [5, 5]]))
    assert best.tolist() == [0, 3] and distance.tolist() == [25, 0]


@pytest.mark.parametrize("scale", [4096, 1 << 29])
def test_nulls_ties_repeats_and_floors(spark, scale):
    rng = np.random.default_rng(2)
    how = vc.Settings(scale=scale, parts=2, entries=3, rounds=3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.02, 4)], [None, 1, 2][i % 3]) for i in rng.permutation(60)]
    rows += rows[:5] + [(7, [0.5, -0.5, 0.01, -1 / 8192], 1), (None, [0.1, 0.2, 0.3, 0.4], None), (None, [0.1, 0.2, 0.3, 0.4], None)]
    rows += [(-5, None, 1), (-4, [0.1, None, 0.2, 0.3], 1), (-3, [0.1, math.nan, 0.2, 0.3], 1), (-2, [math.inf, 0.1, 0.2, 0.3], 1), (90, [0.5], 1), (91, [], 1)]
    assert result(spark, rows, how) == brute(rows, how)
    for few in (rows[:1], rows[:2], rows[-6:], []):
        assert result(spark, few[:4], how) == brute(few[:4], how)


def test_parts_that_do_not_fit_are_errors(spark):
    with pytest.raises(ValueError, match="cannot be cut into 8"):
        result(spark, [(0, [0.5] * 12, 1)], vc.Settings())
    with pytest.raises(Exception, match="vector 1 are too large"):
        result(spark, [(0, [0.5] * 8, 1), (1, [1e30] * 8, 1)], vc.Settings())


def test_entry_sums_beyond_one_limb():
    rows = np.array([[1 << 28, -(1 << 28)]] * 5000 + [[3, 4]])
    assert vc.sums_by_entry(rows, np.array([1] * 5000 + [0]), 3).tolist() == [[3, 4], [5000 << 28, -5000 << 28], [0, 0]]
