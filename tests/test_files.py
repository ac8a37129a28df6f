"""Readers and writers on real files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from vitrine.operators import chunks, training
from vitrine.sources import sinks, tables


def test_url_lines_keep_their_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  u0\t\n\n   \nu1\r\n u2 \n")
    (tmp_path / "b.txt").write_text("u3\n\nu4")
    got = tables.read_url_list(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["url"]) for r in got] == [(i, f"u{i}") for i in range(5)]


def test_url_lines_over_many_splits(spark, tmp_path):
    (tmp_path / "long.txt").write_text("\n".join(f"url-{i}" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert tables.read_url_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        rows = tables.read_url_list(spark, str(tmp_path))
        assert rows.where(F.col("url") != F.concat(F.lit("url-"), F.col("line_no"))).count() == 0
        assert rows.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_html_pages_plain_and_gzip(spark, tmp_path):
    (tmp_path / "f_1.html").write_text("<p>one\ntwo</p>")
    (tmp_path / "f_2.html.gz").write_bytes(gzip.compress("<p>é\n</p>".encode()))
    got = {r["product_id"]: r["html"] for r in tables.read_html(spark, str(tmp_path)).collect()}
    assert got == {"f_1": "<p>one\ntwo</p>", "f_2": "<p>é\n</p>"}


def test_manifest_written_by_hand(spark, tmp_path):
    doc = {"total_urls": 7, "chunk_size": 5, "num_chunks": 2, "chunks": [
        {"chunk_id": 1, "filename": "urls_chunk_0001.txt", "url_count": 5, "start_index": 0, "end_index": 5},
        {"chunk_id": 2, "filename": "urls_chunk_0002.txt", "url_count": 2, "start_index": 5, "end_index": 7}]}
    (tmp_path / "manifest.json").write_text(json.dumps(doc, indent=2))
    got = tables.read_manifest(spark, str(tmp_path / "manifest.json")).orderBy("chunk_id").collect()
    assert [(r["num_chunks"], r["filename"], r["url_count"]) for r in got] == [
        (2, "urls_chunk_0001.txt", 5), (2, "urls_chunk_0002.txt", 2)]
    planned = chunks.manifest(spark.range(7), 5).orderBy("chunk_id").collect()
    assert [r.asDict() for r in planned] == doc["chunks"]


def test_checkpoints(spark, tmp_path):
    (tmp_path / "c1.json").write_text(json.dumps(
        {"container_id": "unit1", "timestamp": "t", "processed": 100, "stats": {"success": 98, "failed": 2}}, indent=2))
    row = tables.read_checkpoints(spark, str(tmp_path)).first()
    assert (row["container_id"], row["processed"], row["success"], row["failed"]) == ("unit1", 100, 98, 2)


def test_logs(spark):
    lines = spark.createDataFrame([
        ("2024-01-15 10:30:45,123 - unit - ERROR - Failed https://h/a/ and https://h/b",),
        ("2024-01-15 10:30:46 - unit - INFO - Saved https://h/c",), ("not a log line",)], "value string")
    rows = tables.parse_log_lines(lines).collect()
    assert [(r["level"], r["logger"], r["links"]) for r in rows] == [
        ("ERROR", "unit", ["https://h/a/", "https://h/b"]), ("INFO", "unit", ["https://h/c"]), ("", "", [])]
    assert sorted(r["url"] for r in tables.failed_links(lines).collect()) == ["https://h/a/", "https://h/b"]


@pytest.mark.parametrize("kind", ["csv", "tsv", "json", "parquet"])
def test_training_files_bring_back_awkward_text(spark, tmp_path, kind):
    texts = ['quote " inside', "comma, tab\t", "line\nbreak", "ünïcode", "back\\slash", "'single'"]
    df = spark.createDataFrame([(i, t, str(i)) for i, t in enumerate(texts)], "i long, text string, url string")
    split = training.with_split(df)
    sinks.write_training(split, str(tmp_path / "era"), "era", kind, mini=True)
    back = tables.read_table(spark, str(tmp_path / "era"), kind, "i long, text string, url string, split string, file string").collect()
    assert {r["i"]: r["text"] for r in back} == dict(enumerate(texts))
    assert all(r["file"] == f"mini_era_{r['split']}.{kind}" for r in back)


def test_rewriting_a_chunk_replaces_only_it(spark, tmp_path):
    rows = spark.createDataFrame([("f_1", 1, "old"), ("f_2", 2, "old")], "product_id string, chunk_id int, v string")
    sinks.write_products(rows, str(tmp_path / "p"))
    table = sinks.write_products(rows.where("chunk_id = 2").withColumn("v", F.lit("new")), str(tmp_path / "p"))
    got = table.read().collect()  # readers follow the manifest
    assert {r["product_id"]: r["v"] for r in got} == {"f_1": "old", "f_2": "new"}


def test_documents_of_one_file_each_are_written_by_several_tasks(spark):
    from vitrine.plans import files as plans

    rows = spark.range(350).coalesce(1).selectExpr("CONCAT('d', id) AS value", "id % 2 AS instance_", "id % 5 AS chunk_")
    path = plans._write_documents(spark, "", one_per_file=True, rows=rows)
    found = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).selectExpr("value", "_metadata.file_path AS f")
    assert sorted(r["value"].strip() for r in found.collect()) == sorted(f"d{i}" for i in range(350))
    assert found.selectExpr("regexp_extract(f, 'part-([0-9]+)-', 1) AS task").distinct().count() > 1
