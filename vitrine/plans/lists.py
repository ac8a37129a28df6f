"""Queries over the order of a list: chunks, slices, last values, running counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import chunks, matching, ordering
from vitrine.plans import inputs as I
from vitrine.plans.registry import query
from vitrine.sources.tables import read_parquet

CHUNK = 1000


def _positioned(spark, sf):
    return ordering.with_position(read_parquet(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


SQL_POSITION = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders"


@query("chunk_assign", f"SELECT o_orderkey, position, position // {CHUNK} + 1 AS chunk_id FROM ({SQL_POSITION})")
def chunk_assign(spark, sf):
    return chunks.assign_chunks(_positioned(spark, sf), CHUNK)


@query("chunk_manifest", f"""SELECT position // {CHUNK} + 1 AS chunk_id, printf('urls_chunk_%04d.txt', position // {CHUNK} + 1) AS filename, count(*) AS url_count,
 min(position) AS start_index, max(position) + 1 AS end_index FROM ({SQL_POSITION}) GROUP BY ALL""")
def chunk_manifest(spark, sf):
    return chunks.manifest(read_parquet(spark, sf, "orders"), CHUNK)


@query("slice_by_position", f"SELECT o_orderkey, position FROM ({SQL_POSITION}) WHERE position >= 700 AND position < 700 + 600")
def slice_by_position(spark, sf):
    return ordering.slice_rows(_positioned(spark, sf), 700, 600)


@query("position_within_group", """SELECT l_suppkey, l_orderkey, l_linenumber,
 row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS position FROM lineitem""")
def position_within_group(spark, sf):
    rows = read_parquet(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    placed = ordering.with_position(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], within=["l_suppkey"])
    return placed.select("l_suppkey", "l_orderkey", "l_linenumber", "position")


@query("first_n_materials", "SELECT p_partkey AS id, array_to_string(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')[1:3], ', ') AS shown FROM part")
def first_n_materials(spark, sf):
    terms = F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")
    return read_parquet(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.array_join(F.slice(terms, 1, 3), ", ").alias("shown"))


@query("dedupe_last_by_id", """SELECT user_id, event_id, event_type FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def dedupe_last_by_id(spark, sf):
    events = read_parquet(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    last = ordering.last_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return last.drop("ts")


@query("progress_milestones", f"""WITH r AS (SELECT container, event_id, row_number() OVER w AS processed, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS success,
 sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER w AS failed FROM ({I.RUN_SQL}) WINDOW w AS (PARTITION BY container ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
 SELECT container, event_id, processed, CAST(success AS BIGINT) AS success, CAST(failed AS BIGINT) AS failed,
 CASE WHEN processed IN (500, 1000, 2500, 5000) THEN 'milestone' ELSE 'progress' END AS stage
 FROM r WHERE processed % 100 = 0 OR processed IN (500, 1000, 2500, 5000)""")
def progress_milestones(spark, sf):
    rows = I.runs(spark, sf).select("container", "ts", "event_id", "ok")
    return ordering.milestones(rows, "container", ["ts", "event_id"], "ok").select(
        "container", "event_id", "processed", "success", "failed", "stage")


@query("tail_log", f"""SELECT container, event_id FROM (SELECT container, event_id, row_number() OVER (PARTITION BY container ORDER BY ts DESC, event_id DESC) AS rn
 FROM ({I.RUN_SQL})) WHERE rn <= 10""")
def tail_log(spark, sf):
    rows = I.runs(spark, sf).select("container", "ts", "event_id")
    return ordering.last_per_key(rows, ["container"], [F.col("ts").desc(), F.col("event_id").desc()], 10).drop("ts")


@query("union_chunk_outputs", """SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS priority FROM orders""")
def union_chunk_outputs(spark, sf):
    orders = read_parquet(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    # three instances, of which only the first records the priority
    part = lambda k: orders.where(F.pmod("id", F.lit(3)) == k)
    return matching.union_outputs([part(0), part(1).drop("priority"), part(2).drop("priority")])
