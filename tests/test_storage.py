"""Stored tables: joins without a shuffle, folders and row groups that are not read."""

import glob

import pyarrow.parquet as pq
import pytest
from plans import physical
from pyspark.sql import functions as F

from vitrine.operators import matching
from vitrine.session import cluster_settings
from vitrine.sources import sinks
from vitrine.workspace import scratch


def scans(df):
    """Metrics of the file scans of a query that has run, as the final plan has them."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan

    def leaves(node):
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            yield from leaves(node.plan())
        elif name == "FileSourceScanExec":
            metrics = node.metrics()
            yield {k: metrics.apply(k).value() for k in ("numFiles", "numOutputRows", "numPartitions") if metrics.contains(k)}
        else:
            children = node.children()
            for i in range(children.size()):
                yield from leaves(children.apply(i))

    return list(leaves(plan))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    left = spark.range(2000).selectExpr("CONCAT('u', id) AS url", "id AS a")
    right = spark.range(0, 4000, 2).selectExpr("CONCAT('u', id % 3000) AS url", "id AS b")
    stored = [sinks.write_bucketed(t, scratch(spark, "bucketed"), "url", 4) for t in (left, right)]
    joined = matching.join_on_url(*stored)
    want = sorted(map(tuple, matching.join_on_url(left, right).select("url", "a", "b").collect()))
    assert sorted(map(tuple, joined.select("url", "a", "b").collect())) == want
    assert "Exchange" not in physical(joined) and "Exchange" in physical(matching.join_on_url(left, right))
    counts = stored[1].groupBy("url").count()
    assert "Exchange" not in physical(counts) and counts.count() == right.select("url").distinct().count()


def test_buckets_are_one_sorted_file_each(spark):
    stored = sinks.write_bucketed(spark.range(1000).selectExpr("CONCAT('u', id) AS url"), scratch(spark, "bucketed"), "url", 4)
    files = stored.inputFiles()
    assert len(files) == 4
    for f in files:
        urls = [r["url"] for r in spark.read.parquet(f).collect()]
        assert urls == sorted(urls)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_completed_chunks_prune_folders_while_the_join_runs(spark, threshold):
    path = scratch(spark, "outputs")
    sinks.write_chunk_outputs(spark.range(20_000).selectExpr("id % 20 AS chunk_id", "id"), path)
    summaries = scratch(spark, "summaries")
    spark.range(20).selectExpr("id AS chunk_id", "IF(id % 7 = 3, 'completed', 'running') AS status").write.parquet(summaries)
    only = "spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly"
    settings = {"spark.sql.autoBroadcastJoinThreshold": threshold, only: cluster_settings(1, 1)[only]}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        done = matching.completed(spark.read.parquet(path), spark.read.parquet(summaries).where("status = 'completed'"))
        assert "dynamicpruning" in physical(done)
        assert {r["chunk_id"] for r in done.collect()} == {3, 10, 17} and done.count() == 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    read = max(scans(done), key=lambda s: s["numOutputRows"])
    assert read["numPartitions"] == 3 and read["numOutputRows"] == 3000
    assert read["numFiles"] == sum(len(glob.glob(f"{path.removeprefix('file:')}/chunk_id={c}/*.parquet")) for c in (3, 10, 17))


def test_a_lookup_reads_one_row_group(spark):
    path = scratch(spark, "pages")
    pages = spark.range(0, 40_000, 2).selectExpr("(id * 7919) % 40000 AS page_id", "repeat(sha2(CAST(id AS STRING), 256), 20) AS html").repartition(8)
    sinks.write_pages(pages, path, codec="uncompressed", group_bytes=256 << 10)
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
    rows = [g.row_group(i).num_rows for g in groups for i in range(g.num_row_groups)]
    assert len(rows) > 40 and sum(rows) == 20_000

    def looked_up(page):
        found = spark.read.parquet(path).where(F.col("page_id") == page)
        return len(found.collect()), sum(s["numOutputRows"] for s in scans(found))

    assert looked_up(1234)[0] == 1 and 0 < looked_up(1234)[1] <= max(rows)
    assert looked_up(-1) == (0, 0)
    # an odd id lies within a group's range, and the Bloom filter tells that it isn't there
    missing = [looked_up(page) for page in range(1, 400, 40)]
    assert {n for n, _ in missing} == {0} and sum(read > 0 for _, read in missing) <= 2
