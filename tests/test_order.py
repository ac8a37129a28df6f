"""Positions, samples and percentiles against brute force, on data where one group holds most rows."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import chunks, matching, ordering

RND = random.Random(7)
ROWS = [("hot" if i % 3 else RND.choice(["a", "b", None]), RND.randrange(50), i) for i in range(5000)]


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(ROWS, "g string, v int, id long").repartition(5).cache()


def test_global_position(skewed):
    got = ordering.with_position(skewed, ["v", "id"], parts=7).collect()
    expected = {r[2]: i for i, r in enumerate(sorted(ROWS, key=lambda r: (r[1], r[2])))}
    assert {r["id"]: r["position"] for r in got} == expected


def test_position_and_running_sum_within_a_hot_group(skewed):
    got = ordering.with_position(skewed, ["v", "id"], within=["g"], parts=7, running={"total": F.col("v").cast("long")})
    groups = defaultdict(list)
    for r in ROWS:
        groups[r[0]].append(r)
    expected = {}
    for rows in groups.values():
        total = 0
        for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2]))):
            total += r[1]
            expected[r[2]] = (i, total)
    assert {r["id"]: (r["position"], r["total"]) for r in got.collect()} == expected


def test_hot_group_is_spread_over_partitions(skewed):
    placed = ordering._placed(skewed, [F.col("g"), F.col("v"), F.col("id")], 7)
    assert placed.where("g = 'hot'").select("_part").distinct().count() > 3


def test_chunks_cover_the_list(skewed, spark):
    chunked = chunks.assign_chunks(ordering.with_position(skewed, ["v", "id"], parts=3), 700)
    counted = sorted(map(tuple, chunks.manifest_of(chunked).collect()))
    planned = sorted((r["chunk_id"], r["url_count"], r["start_index"], r["end_index"])
                     for r in chunks.manifest(skewed, 700).collect())
    assert counted == planned
    assert planned[-1] == (8, 100, 4900, 5000)


@pytest.mark.parametrize("start, size", [(0, 10), (2, 2), (4995, 50), (9999, 5)])
def test_slice(skewed, start, size):
    got = ordering.slice_rows(ordering.with_position(skewed, ["id"]), start, size)
    assert sorted(r["id"] for r in got.collect()) == list(range(5000))[start:start + size]


def test_empty_list(spark):
    none = spark.createDataFrame([], "id long")
    assert chunks.manifest(none, 10).count() == 0
    assert ordering.with_position(none, ["id"]).count() == 0


def test_rank_with_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, n long")
    assert {r["k"]: r["rank"] for r in ordering.with_rank(df, "n", "k").collect()} == {"b": 1, "a": 2, "c": 2, "d": 4}


@pytest.mark.parametrize("fraction", [0.1, 0.37, 1.0])
def test_sample_takes_exactly_the_first_by_hash(skewed, fraction):
    # One hex digit of prefix forces many rows into the bucket where the quota is reached.
    got = ordering.sample_per_stratum(skewed, "g", F.col("id").cast("string"), fraction, buckets_hex=1)
    expected = set()
    for g in {r[0] for r in ROWS}:
        ids = sorted((hashlib.md5(str(r[2]).encode()).hexdigest(), r[2]) for r in ROWS if r[0] == g)
        expected |= {i for _, i in ids[: math.ceil(len(ids) * fraction)]}
    assert {r["id"] for r in got.collect()} == expected


@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("accuracy", [50, 20_000])
def test_percentile_is_exact(skewed, fraction, accuracy):
    """With accuracy 50 the groups are far larger than the sketch, so the bracket is used."""
    df = skewed.withColumn("x", F.pow(F.col("v") + 1, 2) + F.col("id") / 7)
    got = {r["g"]: r["p"] for r in ordering.exact_percentile(df, ["g"], "x", fraction, "p", accuracy).collect()}
    for g in {r[0] for r in ROWS}:
        values = [(r[1] + 1) ** 2 + r[2] / 7 for r in ROWS if r[0] == g]
        assert got[g] == pytest.approx(np.percentile(values, fraction * 100), rel=1e-12)


def test_percentile_of_everything_and_with_positions(skewed, monkeypatch):
    df = skewed.withColumn("x", F.col("id") * 1.5)
    expected = np.percentile([r[2] * 1.5 for r in ROWS], 95)
    assert ordering.exact_percentile(df, [], "x", 0.95, "p").first()["p"] == pytest.approx(expected)
    by_group = {r["g"]: r["p"] for r in ordering.exact_percentile(df, ["g"], "x", 0.5, "p", 100).collect()}
    assert by_group["hot"] == pytest.approx(np.percentile([r[2] * 1.5 for r in ROWS if r[0] == "hot"], 50))


def test_last_per_key_keeps_the_newest_and_limits_before_the_shuffle(skewed):
    last = ordering.last_per_key(skewed, ["g"], [F.col("v").desc(), F.col("id").desc()])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    expected = {}
    for g, v, i in ROWS:
        expected[g] = max(expected.get(g, (-1, -1)), (v, i))
    assert {r["g"]: (r["v"], r["id"]) for r in last.collect()} == expected


def test_pending_and_done_make_the_whole(spark):
    listed = spark.range(100).select(F.concat(F.lit("u"), F.col("id")).alias("url"))
    done = listed.where("url < 'u5'").unionByName(listed.where("url = 'u1'"))
    left = matching.pending(listed, done)
    assert left.count() + done.distinct().count() == 100
    assert left.join(done, "url").count() == 0


def test_round_robin_and_names(spark):
    three = spark.range(1, 4).withColumnRenamed("id", "chunk_id")
    got = chunks.round_robin(three, ["A", "B"]).orderBy("chunk_id").collect()
    assert [r["instance"] for r in got] == ["A", "B", "A"]
    pool = chunks.numbered(spark, ["apollo", "Bad1", "gemini"], "name")
    assert [r["name"] for r in chunks.assign_names(three, pool).orderBy("chunk_id").collect()] == ["apollo", None, "gemini"]


def test_match_files(spark):
    html = spark.createDataFrame([("f_1",), ("f_1",), ("f_2",)], "product_id string")
    docs = spark.createDataFrame([("f_1",), ("f_3",)], "product_id string")
    got = {r["product_id"]: (r["html_files"], r["json_files"], r["state"]) for r in matching.match_files(html, docs).collect()}
    assert got == {"f_1": (2, 1, "both"), "f_2": (1, 0, "html_only"), "f_3": (0, 1, "json_only")}
