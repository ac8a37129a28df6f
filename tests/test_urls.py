"""URL goldens, derived by hand from the rules."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vitrine.functions import urls as U
from vitrine.operators import quality, training

HOST = "www.market.example"

# (path below the host, years or decades in it): our own small catalogue, two departments of unequal depth.
CATALOGUE = {
    "garden/benches/slatted-bench-1984/id-f_9001": 1980,
    "garden/benches/folding-bench-1990s/id-f_9002": 1990,
    "garden/urns/stoneware-urn-1890s/id-f_9003": 1890,
    "garden/sundials/armillary-sundial/id-f_9004": None,
    "instruments/clocks/mantel/enamel-clock-1907/id-f_9005": 1900,
    "instruments/clocks/mantel/skeleton-clock-1910s/id-f_9006": 1910,
    "instruments/clocks/wall/regulator-1880s/id-f_9007": 1880,
    "instruments/barometers/stick-barometer-1840s/id-f_9008": 1840,
    "instruments/barometers/wheel-barometer-1845/id-f_9009": 1840,
}
LISTED = [f"https://{HOST}/{path}/" for path in CATALOGUE]


@pytest.fixture(scope="module")
def features(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(LISTED)], "id long, url string")
    return U.with_url_features(df).cache()


def counts(df, by):
    return {r[by]: r["count"] for r in df.groupBy(by).count().collect()}


def test_categories_decades_depth(features):
    assert counts(features, "secondary_category") == {"benches": 2, "urns": 1, "sundials": 1, "clocks": 3, "barometers": 2}
    assert counts(features, "decade") == {d: list(CATALOGUE.values()).count(d) for d in set(CATALOGUE.values())}
    assert counts(features, "depth_level") == {4: 6, 5: 3}


def test_sequences_are_depth_minus_one_per_url(features):
    seq = training.sequence_table(features)
    assert seq.count() == 6 * 3 + 3 * 4
    steps = seq.where(F.col("url") == LISTED[4]).orderBy("sequence_length").collect()
    assert [(s["sequence"], s["target"]) for s in steps] == [
        ("instruments", "clocks"), ("instruments clocks", "mantel"), ("instruments clocks mantel", "enamel-clock-1907"),
        ("instruments clocks mantel enamel-clock-1907", "id-f_9005"),
    ]


def test_one_segment_gives_no_sequence(spark):
    df = spark.createDataFrame([("https://h/only",), ("https://h/",), ("https://h",)], "url string")
    assert training.sequence_table(U.with_url_features(df)).count() == 0


def test_full_record(spark):
    url = f"https://{HOST}/instruments/pocket-globes/Nairne-celestial-globe-of-1776-in-case/id-f_40213/"
    row = U.with_url_features(spark.createDataFrame([(url,)], "url string")).first()
    assert row["domain"] == HOST
    assert row["path_segments"] == ["instruments", "pocket-globes", "Nairne-celestial-globe-of-1776-in-case", "id-f_40213"]
    assert (row["depth_level"], row["item_id"], row["product_id"]) == (4, "40213", "f_40213")
    assert row["category_hierarchy"] == ["instruments", "pocket-globes"]
    assert row["extracted_terms"] == "instruments pocket globes Nairne celestial globe of 1776 in case id f_40213".split()
    assert row["all_terms"] == " ".join(row["extracted_terms"])
    assert row["hyphenated_terms"] == ["pocket-globes", "Nairne-celestial-globe-of-1776-in-case"]
    assert row["numeric_values"] == ["1776", "40213"]


def md5(url):
    return hashlib.md5(url.encode()).hexdigest()[:10]


NO_ID = f"https://{HOST}/a/b/"
CASES = [
    # url, product id, matches the listing pattern, reject reason
    (NO_ID, md5(NO_ID), False, "no id"),
    (f"https://{HOST}/id-f_1/", "f_1", False, None),
    (f"https://{HOST}/x/id-f_1/", "f_1", True, None),
    (f"http://{HOST}/x/id-f_1/", "f_1", False, "scheme"),
    ("https://other.example/x/id-f_1/", "f_1", False, "host"),
    (f"https://{HOST}/x/../id-f_1/", "f_1", True, "path"),
    (f"https://{HOST}/x//id-f_1/", "f_1", True, "path"),
    (f"https://{HOST}/x/id-f_12?p=1", "f_12?p=1", False, "no id"),
    (f"https://{HOST}/x/id-f_ab/", "f_ab", False, "no id"),
    ("http://a b/c", md5("http://a b/c"), False, "scheme"),
    (f"https://{HOST}/x/id-f_1/y/id-f_2/", "f_1", True, None),
]


def test_malformed_urls(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, url string")
    got = df.select(
        "id", U.product_id(F.col("url")).alias("p"), quality.is_listing_url(F.col("url"), HOST).alias("v"),
        quality.url_reject_reason(F.col("url"), HOST).alias("r"),
    ).orderBy("id").collect()
    assert [(r["p"], r["v"], r["r"]) for r in got] == [c[1:] for c in CASES]


@pytest.mark.parametrize(
    "slug, decade",
    [("lamp-1953", 1950), ("lamp-1980s", 1980), ("1890-lamp", 1890), ("lamp-1799", None), ("lamp-2030", None),
     ("lamp-19805", None), ("lamp19", None), ("f-2029", 2020), ("two-1950s-and-1960s", 1950)],
)
def test_decade(spark, slug, decade):
    assert spark.range(1).select(U.decade(F.lit(slug))).first()[0] == decade


def test_splits_are_disjoint_complete_and_near_70_10_20(spark):
    df = training.with_split(spark.range(20_000).select(F.concat(F.lit("u"), F.col("id")).alias("url")))
    n = counts(df, "split")
    assert sum(n.values()) == 20_000
    assert abs(n["train"] - 14_000) < 300 and abs(n["validation"] - 2_000) < 200 and abs(n["test"] - 4_000) < 250


def test_text_forms(features):
    assert training.text_table(features).count() == 3 * len(LISTED)
    assert {r["decade"] for r in training.text_table(features).select("decade").distinct().collect()} >= {0, 1980}
