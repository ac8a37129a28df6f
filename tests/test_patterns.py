"""Frequent sets, rules and paths against plain enumeration."""

from itertools import combinations

import pytest

from vitrine.operators import patterns

BASKETS = [["a", "b", "c"], ["a", "b", "b"], ["b", "c", "d", "e"], ["a", "b", "c", "d", "e"], ["c", "c"], [], None, ["a", None, "b", "c", "d", "e"], ["e", "d", "b", "c"]]


def plain_sets(baskets, least):
    sets = [set(b) - {None} for b in baskets if b]
    items = sorted(set().union(*sets))
    out = {}
    for k in range(1, len(items) + 1):
        for c in combinations(items, k):
            n = sum(set(c) <= s for s in sets)
            if n >= least:
                out[c] = n
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, b) for i, b in enumerate(BASKETS)], "id int, items array<string>")


@pytest.mark.parametrize("least", [1, 2, 3, 5, 7, 50])
def test_sets_of_every_size(frame, least):
    want = plain_sets(BASKETS, least)
    found = patterns.frequent_sets(frame, "items", least)
    assert {tuple(r["items"]): r["n"] for r in found.collect()} == want
    assert all(r["size"] == len(r["items"]) for r in found.collect())
    closed = {c: n for c, n in want.items() if not any(set(c) < set(d) and n == m for d, m in want.items())}
    assert {tuple(r["items"]): r["n"] for r in patterns.closed_sets(found).collect()} == closed


def test_sets_of_four_and_more_in_a_larger_table(spark):
    import random

    r = random.Random(3)
    baskets = [[w for w in "abcdefghij" if r.random() < 0.55] for _ in range(300)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    want = plain_sets(baskets, 25)
    assert max(map(len, want)) >= 4
    assert {tuple(x["items"]): x["n"] for x in patterns.frequent_sets(df, "items", 25).collect()} == want


def test_rules(frame):
    want, rows = plain_sets(BASKETS, 2), sum(bool(b) for b in BASKETS)
    expected = {}
    for c, n in want.items():
        for item in c if len(c) > 1 else ():
            rest = tuple(x for x in c if x != item)
            if n >= 0.8 * want[rest]:
                expected[rest, item] = (n, n / want[rest], n / want[rest] * rows / want[(item,)])
    found = patterns.rules(patterns.frequent_sets(frame, "items", 2), rows, 0.8).collect()
    assert {(tuple(r["antecedent"]), r["consequent"]): pytest.approx((r["n"], r["confidence"], r["lift"])) for r in found} == expected


@pytest.mark.parametrize("least", [1, 2, 4, 99])
def test_paths(frame, least):
    def parts(path):
        path = [s for s in path or [] if s is not None]
        return {tuple(path[i] for i in c) for k in range(1, 4) for c in combinations(range(len(path)), k)}

    counts = {}
    for p in BASKETS:
        for x in parts(p):
            counts[x] = counts.get(x, 0) + 1
    found = patterns.frequent_paths(frame, "items", least, longest=3).collect()
    assert {tuple(r["path"]): r["n"] for r in found} == {p: n for p, n in counts.items() if n >= least}
    assert all(r["length"] == len(r["path"]) for r in found)


def test_learners_get_few_rows_in_each_partition(spark, monkeypatch):
    """The learners cache what they get as objects, so one file of short rows must not be one task."""
    given = []
    for learner, method in ((patterns.FPGrowth, "fit"), (patterns.PrefixSpan, "findFrequentSequentialPatterns")):
        def recorded(self, df, original=getattr(learner, method)):
            given.append(df.rdd.glom().map(len).collect())
            return original(self, df)
        monkeypatch.setattr(learner, method, recorded)
    monkeypatch.setattr(patterns, "ROWS_PER_TASK", 25, raising=False)
    df = spark.createDataFrame([(b,) for b in BASKETS[:4] * 200], "items array<string>").coalesce(1)
    want = {c: 200 * n for c, n in plain_sets(BASKETS[:4], 2).items()}
    assert {tuple(r["items"]): r["n"] for r in patterns.frequent_sets(df, "items", 400).collect()} == want
    assert patterns.frequent_paths(df, "items", 400, longest=2).count() > 0
    assert len(given) == 2 and all(sum(sizes) == 800 and max(sizes) <= 50 for sizes in given)
