"""Quotas of several distributions at once."""

import math
import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import quotas


def sums(table, side):
    out = {}
    for key, x in table.items():
        out[key[side]] = out.get(key[side], 0) + x
    return out


def test_rounding_keeps_cells_rows_and_columns_next_to_their_values():
    for seed in range(120):
        r = random.Random(seed)
        rows, columns = r.randint(1, 12), r.randint(1, 12)
        table = {(i, j): r.choice([0, r.random(), r.random() * 9, r.randint(0, 4), 0.1 * r.randint(0, 40)]) for i in range(rows) for j in range(columns) if r.random() < 0.8}
        found = quotas.rounded(table)
        assert found.keys() == table.keys() and all(abs(found[k] - x) < 1 - 1e-12 or abs(x - round(x)) < 1e-6 for k, x in table.items())
        for side in (0, 1):
            for k, x in sums(table, side).items():
                assert abs(sums(found, side)[k] - x) < 1 + 1e-6


def test_fitting_reaches_other_margins():
    r = random.Random(1)
    cells = {(i, j, k): r.random() + 0.1 for i in range(4) for j in range(3) for k in range(5)}
    margins = [{i: 30.0 for i in range(4)}, {0: 60.0, 1: 40.0, 2: 20.0}, {k: 24.0 for k in range(5)}]
    found = quotas.fitted(cells, margins)
    for d in range(3):
        assert sums(found, d) == pytest.approx(margins[d], rel=1e-9)
    # the odds within the table stay those of the cells
    odds = lambda t: t[0, 0, 0] * t[1, 1, 0] / (t[0, 1, 0] * t[1, 0, 0])
    assert odds(found) == pytest.approx(odds(cells), rel=1e-9)


@pytest.mark.parametrize("dimensions", [2, 3, 4])
def test_all_margins_are_within_one_row(dimensions):
    for seed in range(25):
        r = random.Random(seed)
        counts = {}
        for _ in range(r.randint(1, 3000)):
            key = tuple(min(int(r.expovariate(0.5)), 9) for _ in range(dimensions))
            counts[key] = counts.get(key, 0) + 1
        margins = [{v: 0.1 * n for v, n in m.items()} for m in quotas.margin_counts(counts, dimensions)]
        found = quotas.cell_quotas(counts, margins)
        assert all(0 <= found[k] <= n for k, n in counts.items())
        for d in range(dimensions):
            got = sums(found, d)
            assert all(abs(got[v] - x) < 1 + 1e-6 for v, x in margins[d].items())
        assert abs(sum(found.values()) - 0.1 * sum(counts.values())) < len(margins[0]) + 1


def test_the_sample_is_the_first_rows_of_each_cell_by_hash(spark):
    rows = [(f"u{i}", "a" if i % 3 else None, i % 7, (i * i) % 4) for i in range(2000)]
    df = spark.createDataFrame(rows, "url string, x string, y long, z long")
    sample = quotas.balanced_sample(df, ["x", "y", "z"], "url", 0.1)
    assert sample.columns == df.columns
    got = [tuple(r) for r in sample.withColumn("h", F.md5("url")).collect()]
    whole = [tuple(r) for r in df.withColumn("h", F.md5("url")).collect()]
    for d in (1, 2, 3):
        for v in {r[d] for r in rows}:
            assert abs(sum(r[d] == v for r in got) - 0.1 * sum(r[d] == v for r in whole)) < 1
    for cell in {r[1:4] for r in rows}:
        taken, all_ = sorted(r[4] for r in got if r[1:4] == cell), sorted(r[4] for r in whole if r[1:4] == cell)
        assert taken == all_[: len(taken)]
    assert quotas.balanced_sample(df.limit(0), ["x", "y"], "url", 0.1).count() == 0
    assert math.isclose(len(got), 200, abs_tol=3)
    with pytest.raises(ValueError):
        quotas.balanced_sample(df, ["x"], "url", 0.1)
