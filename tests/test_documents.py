"""Collected documents: every form, one file each."""

import json

import pytest
from pyspark.sql import functions as F

from vitrine.functions import money
from vitrine.operators import extraction, ordering, summaries
from vitrine.sources import tables

DOCS = {
    "instance_1/chunk_1/extracted/f_1.json": {"product_id": "f_1", "category": "Seating", "price": "$950", "materials": ["Wood"]},
    "instance_1/chunk_1/extracted/f_2.json": {
        "url": "u2", "data": {"product_info": {"product_id": "f_2", "title": "T"}, "pricing": {"price": "5400"},
                              "specifications": {"category": "Tables", "materials": "Walnut"}}},
    "instance_1/chunk_1/extracted/f_3.json": {"product_id": "f_3", "category": "Tables", "price": None},
    "instance_1/chunk_2/extracted/f_4.json": {"product_info": {"product_id": "f_4"},
                                              "specifications": {"category": "Night Stands", "materials": "Walnut, Marble"}},
    "instance_1/chunk_2/extracted/f_5.json": [{"product_id": "f_5"}, {"product_id": "f_6"}],
    "instance_1/chunk_2/extracted/f_6.json": '{"broken": ',
    "instance_1/chunk_2/extracted/f_7.json": {"product_id": "f_7", "category": None, "price": 12000},
    "instance_2/chunk_3/extracted/f_1.json": {"product_id": "f_1", "category": "Seating", "price": "$1,000"},
    # Not collected: outside `extracted`, or of another kind.
    "instance_2/chunk_3/logs/f_9.json": {"product_id": "f_9"},
    "instance_2/chunk_3/extracted/f_9.txt": {"product_id": "f_9"},
}


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("collected")
    for name, doc in DOCS.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2))
    return extraction.land_documents(tables.read_documents(spark, str(root)))


def test_statistics(documents):
    row = summaries.merge_statistics(documents).first().asDict()
    assert row == {"files_found": 8, "total_products": 6, "with_price": 4, "with_materials": 3, "errors": 1, "non_object": 1}


def test_categories_count_an_explicit_null(documents):
    counts = summaries.distribution(documents.where("kind = 'product' AND has_category"), "category")
    assert {r["category"]: r["n"] for r in counts.collect()} == {"Seating": 2, "Tables": 2, "Night Stands": 1, None: 1}


def test_bands(documents):
    band = money.price_band(F.col("amount"), *money.PRICE_BANDS)
    rows = summaries.band_counts(documents.where("kind = 'product'"), band, money.PRICE_BANDS[1] + [money.NO_PRICE])
    assert {r["band"]: r["n"] for r in rows.collect()} == {
        "under_1000": 1, "1000_5000": 1, "5000_10000": 1, "10000_50000": 1, "over_50000": 0, "no_price": 2}


def test_instances_and_chunks(documents):
    row = documents.agg(F.count_distinct("instance").alias("i"), F.count_distinct("instance", "chunk").alias("c")).first()
    assert (row["i"], row["c"]) == (2, 3)


def test_dedupe(documents):
    last = ordering.last_per_key(documents.where("kind = 'product'"), ["product_id"], [F.col("file").desc()])
    assert last.count() == 5
    assert last.where("product_id = 'f_1'").first()["price"] == "$1,000"


def test_material_lists(documents):
    got = {(r["product_id"], r["instance"]): r["materials"] for r in documents.where("kind = 'product'").collect()}
    assert got[("f_1", "1")] == ["Wood"]
    assert got[("f_2", "1")] == ["Walnut"]
    assert got[("f_4", "1")] == ["Walnut", "Marble"]
    assert got[("f_3", "1")] is None


@pytest.mark.parametrize("price, shown", [("0", "0"), (0, None), ("", ""), (False, None), ([], None), ({}, None), (12.5, "12.5")])
def test_empty_prices(spark, price, shown):
    raw = spark.createDataFrame([(json.dumps({"product_id": "f_1", "price": price}),)], "value string")
    row = extraction.flatten_documents(extraction.parse_documents(raw)).first()
    assert row["price"] == shown
    assert row["has_price"] == bool(price)


def test_summary_is_no_product(spark):
    raw = spark.createDataFrame([('{"total_processed": 3}',), ("12",), ('"x"',), ("",)], "value string")
    assert [r["kind"] for r in extraction.parse_documents(raw).collect()] == ["non_product", "non_object", "non_object", "corrupt"]


PRICES = [("$5,400", 5400.0), ("0", 0.0), (" 12 ", 12.0), ("1e3", 1000.0), ("-5", -5.0), ("+5.", 5.0), (".5", 0.5),
          ("", None), (None, None), ("€4,831", None), ("Price on request", None), ("1.0d", None), ("nan", None),
          ("inf", None), ("1_000", None), ("1 2", None), ("$", None)]


def test_parse_money(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PRICES)], "i int, p string")
    got = df.select("i", money.parse_money(F.col("p")).alias("m")).orderBy("i").collect()
    assert [r["m"] for r in got] == [m for _, m in PRICES]


EDGES = [(999.99, "under_1000"), (1000, "1000_5000"), (4999.99, "1000_5000"), (5000, "5000_10000"), (9999.99, "5000_10000"),
         (10000, "10000_50000"), (49999.99, "10000_50000"), (50000, "over_50000"), (-5, "under_1000"), (None, "no_price")]


def test_band_edges(spark):
    df = spark.createDataFrame([(i, None if p is None else float(p)) for i, (p, _) in enumerate(EDGES)], "i int, p double")
    got = df.select("i", money.price_band(F.col("p"), *money.PRICE_BANDS).alias("b")).orderBy("i").collect()
    assert [r["b"] for r in got] == [b for _, b in EDGES]
