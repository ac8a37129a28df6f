"""Training table queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from vitrine.functions import urls as U
from vitrine.operators import extraction, patterns, quality, quotas, similarity, training
from vitrine.plans import inputs as I
from vitrine.plans import pages as P
from vitrine.plans.registry import query
from vitrine.plans.urls import features_sql
from vitrine.sources.tables import read_parquet
from vitrine.workspace import partitions_for, stage


def _features(spark, sf):
    return U.with_url_features(I.url_rows(spark, sf))


def _flat(spark, sf, *fields):
    """Flat products with the fields that a query reads."""
    return extraction.flatten_extracted(extraction.land_products(I.product_pages(spark, sf), fields=fields))


@query("ds_category", f"{features_sql()} SELECT url, item_description, all_terms, primary_category, secondary_category FROM features")
def ds_category(spark, sf):
    return training.category_table(_features(spark, sf))


@query("ds_item_type", f"{features_sql()} SELECT url, item_description, all_terms, tertiary_category AS item_type FROM features WHERE tertiary_category IS NOT NULL")
def ds_item_type(spark, sf):
    return training.item_type_table(_features(spark, sf))


@query("ds_era", f"{features_sql()} SELECT url, item_description, all_terms, decade AS primary_decade FROM features WHERE decade IS NOT NULL")
def ds_era(spark, sf):
    return training.era_table(_features(spark, sf))


@query("ds_depth", f"{features_sql()} SELECT url, all_terms, array_to_string(hyphenated, ' ') AS hyphenated_terms, depth_level FROM features")
def ds_depth(spark, sf):
    return training.depth_table(_features(spark, sf))


@query("ds_text_embeddings", f"""{features_sql()} SELECT text, url, primary_category, secondary_category, coalesce(decade, 0) AS decade FROM
 (SELECT item_description AS text, * FROM features UNION ALL SELECT all_terms, * FROM features UNION ALL SELECT array_to_string(hyphenated, ' '), * FROM features)
 WHERE text IS NOT NULL AND text <> ''""")
def ds_text_embeddings(spark, sf):
    return training.text_table(_features(spark, sf))


@query("ds_sequences", f"""{features_sql()} SELECT array_to_string(seg[1:k], ' ') AS sequence, seg[k + 1] AS target, k AS sequence_length, url
 FROM (SELECT url, seg, unnest(range(1, len(seg))) AS k FROM features)""")
def ds_sequences(spark, sf):
    return training.sequence_table(_features(spark, sf))


SQL_BUCKET = "('0x' || substr(md5(url), 1, 8))::BIGINT % 100"
SQL_SPLIT = f"CASE WHEN {SQL_BUCKET} < 70 THEN 'train' WHEN {SQL_BUCKET} < 80 THEN 'validation' ELSE 'test' END"


@query("ds_split", f"WITH u AS ({I.URLS_SQL}) SELECT id, {SQL_SPLIT} AS split FROM u")
def ds_split(spark, sf):
    return training.with_split(I.url_rows(spark, sf)).select("id", "split")


@query("ds_mini_sample", f"""{features_sql()} SELECT url, secondary_category FROM (SELECT url, secondary_category,
 row_number() OVER (PARTITION BY secondary_category ORDER BY md5(url), url) AS rn, count(*) OVER (PARTITION BY secondary_category) AS n FROM features)
 WHERE rn <= ceil(n * 0.1)""")
def ds_mini_sample(spark, sf):
    f = I.url_rows(spark, sf).select("url", U.category_level(U.path_segments(F.col("url")), 1).alias("secondary_category"))
    return training.mini_sample(f)


SAMPLED = ["secondary_category", "decade", "depth_level"]
SQL_MARGINS = " UNION ALL ".join(f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS rows, true AS kept FROM features GROUP BY {d}" for d in SAMPLED)


@query("ds_balanced_sample", f"{features_sql()} {SQL_MARGINS}")
def ds_balanced_sample(spark, sf):
    """Of a sample that keeps three distributions at once: for each value of each whether it has a tenth of its rows, within one."""
    f = stage(_features(spark, sf).select("url", *SAMPLED), "features")
    sample = stage(quotas.balanced_sample(f, SAMPLED, "url", 0.1), "sample")
    found = None
    for d in SAMPLED:
        value = F.col(d).cast("string").alias("value")
        taken = sample.groupBy(value).agg(F.count(F.lit(1)).alias("taken")).withColumnRenamed("value", "of")
        whole = f.groupBy(value).agg(F.count(F.lit(1)).alias("rows"))
        both = whole.join(taken, F.col("value").eqNullSafe(F.col("of")), "left")
        rows = both.select(F.lit(d).alias("dimension"), "value", "rows", (F.abs(F.coalesce("taken", F.lit(0)) - F.col("rows") * 0.1) < 1).alias("kept"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query("ds_image_pairs", f"""SELECT 'f_' || p_partkey AS product_id, i - 1 AS image_index, 'https://cdn.market.example/' || p_partkey || '_' || i || '.jpg' AS image, p_type AS label
 FROM (SELECT *, unnest(range(1, 1 + {P.SQL_IMAGES})) AS i FROM part WHERE {P.SQL_HAS_NODE})""")
def ds_image_pairs(spark, sf):
    return training.image_pairs(_flat(spark, sf, "product_id", "category", "images"))


SQL_MATERIAL_LABELS = f"CASE WHEN NOT {P.SQL_NAMED} THEN '' WHEN p_partkey % 2 = 0 THEN 'Walnut|Brass' ELSE 'Walnut|Glass' END"
SQL_STYLE_LABELS = f"concat_ws('|', CASE WHEN {P.SQL_NAMED} THEN 'Art Deco' END, (1900 + p_partkey % 10 * 10) || 's')"


@query("ds_taxonomy", f"""WITH i AS (SELECT *, 'f_' || p_partkey AS product_id, unnest({P.SQL_IMAGE_LIST}) AS image FROM part WHERE {P.SQL_HAS_NODE}),
 l AS (SELECT product_id, image, p_type AS c, {SQL_MATERIAL_LABELS} AS m, {SQL_STYLE_LABELS} AS s FROM i)
 SELECT product_id, image, 'category' AS label_set, c AS labels FROM l UNION ALL SELECT product_id, image, 'materials', m FROM l
 UNION ALL SELECT product_id, image, 'style_period', s FROM l
 UNION ALL SELECT product_id, image, 'multi_label', concat_ws('|', c, nullif(m, ''), s) FROM l""")
def ds_taxonomy(spark, sf):
    products = _flat(spark, sf, "product_id", "category", "period", "materials", "style", "images")
    rows = training.taxonomy(products).withColumn("labels", F.array_join("labels", "|"))
    return quality.without_private(rows, ["image", "label_set", "labels"])


@query("term_patterns", f"""{features_sql()}, g AS (SELECT 1 AS size, unnest(terms) AS term FROM features
 UNION ALL SELECT 2, terms[k] || ' ' || terms[k + 1] FROM (SELECT terms, unnest(range(1, len(terms))) AS k FROM features))
 SELECT size, term, count(*) AS n FROM g GROUP BY ALL""")
def term_patterns(spark, sf):
    terms = I.url_rows(spark, sf).select(U.extracted_terms(U.path(F.col("url"))).alias("terms"))
    return training.term_patterns(terms, "terms")


@query("document_terms", r"""SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY 1""")
def document_terms(spark, sf):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    return training.term_counts(read_parquet(spark, sf, "documents").select(words.alias("terms")), "terms")


LEAST_SHARE = 0.04
SQL_SETS = f"""{features_sql().replace('WITH src', 'WITH RECURSIVE src', 1)},
 bound AS (SELECT ceil(count(*) * {LEAST_SHARE})::BIGINT AS least FROM features),
 single AS (SELECT term, list(id) AS ids FROM (SELECT id, unnest(list_distinct(terms)) AS term FROM features) GROUP BY 1 HAVING count(*) >= (SELECT least FROM bound)),
 sets AS (SELECT [term] AS items, term AS last, ids FROM single
  UNION ALL SELECT list_append(items, s.term), s.term, list_intersect(sets.ids, s.ids) FROM sets JOIN single s ON s.term > last
   AND len(list_intersect(sets.ids, s.ids)) >= (SELECT least FROM bound))"""


def _term_sets(spark, sf):
    terms = I.url_rows(spark, sf).select(U.extracted_terms(U.path(F.col("url"))).alias("terms"))
    rows = terms.count()
    return patterns.frequent_sets(terms, "terms", math.ceil(rows * LEAST_SHARE)), rows


@query("term_itemsets", f"{SQL_SETS} SELECT array_to_string(items, ' ') AS items, len(items)::INT AS size, len(ids) AS n FROM sets")
def term_itemsets(spark, sf):
    sets, _ = _term_sets(spark, sf)
    return sets.select(patterns.shown(F.col("items")).alias("items"), "size", "n")


@query("term_rules", f"""{SQL_SETS}, f AS (SELECT items, len(ids) AS n FROM sets),
 r AS (SELECT list_filter(items, lambda i: i <> c) AS antecedent, c, n FROM (SELECT items, n, unnest(items) AS c FROM f WHERE len(items) > 1))
 SELECT array_to_string(antecedent, ' ') AS antecedent, c AS consequent, r.n, round(r.n / a.n, 6) AS confidence,
  round(r.n / a.n * (SELECT count(*) FROM features) / s.n, 6) AS lift
 FROM r JOIN f a ON a.items = antecedent JOIN f s ON s.items = [c] WHERE r.n >= 0.9 * a.n""")
def term_rules(spark, sf):
    sets, rows = _term_sets(spark, sf)
    found = patterns.rules(sets, rows, 0.9)
    return found.select(patterns.shown(F.col("antecedent")).alias("antecedent"), "consequent", "n", F.round("confidence", 6).alias("confidence"), F.round("lift", 6).alias("lift"))


@query("path_patterns", f"""{features_sql()}, n AS (SELECT ceil(count(*) * {LEAST_SHARE})::BIGINT AS least FROM features),
 p AS (SELECT id, [seg[i]] AS path FROM (SELECT id, seg, unnest(range(1, len(seg) + 1)) AS i FROM features)
  UNION ALL SELECT id, [seg[i], seg[j]] FROM (SELECT id, seg, i, unnest(range(i + 1, len(seg) + 1)) AS j FROM (SELECT id, seg, unnest(range(1, len(seg) + 1)) AS i FROM features))
  UNION ALL SELECT id, [seg[i], seg[j], seg[k]] FROM (SELECT id, seg, i, j, unnest(range(j + 1, len(seg) + 1)) AS k FROM
   (SELECT id, seg, i, unnest(range(i + 1, len(seg) + 1)) AS j FROM (SELECT id, seg, unnest(range(1, len(seg) + 1)) AS i FROM features))))
 SELECT array_to_string(path, ' ') AS path, len(path)::INT AS length, count(DISTINCT id) AS n FROM p GROUP BY path HAVING count(DISTINCT id) >= (SELECT least FROM n)""")
def path_patterns(spark, sf):
    paths = I.url_rows(spark, sf).select(U.path_segments(F.col("url")).alias("segments"))
    found = patterns.frequent_paths(paths, "segments", math.ceil(paths.count() * LEAST_SHARE), longest=3)
    return found.withColumn("path", patterns.shown(F.col("path")))


# Words of the path before the id segment.
SQL_WORDS = "list_sort(list_distinct(list_filter(regexp_split_to_array(array_to_string(seg[1:greatest(len(seg) - 1, 0)], '/'), '[/-]'), lambda t: t <> '')))"
ALIKE = 0.6


def _words(spark, sf):
    segments = U.path_segments(F.col("url"))
    named = F.array_join(F.slice(segments, F.lit(1), F.greatest(F.size(segments) - 1, F.lit(0))), "/")
    rows = I.url_rows(spark, sf)
    return rows.repartition(partitions_for(rows, 1 << 20), "url").select("url", F.filter(F.split(named, "[/-]"), lambda t: t != "").alias("terms"))


@query("similar_listings", f"""{features_sql()}, nodes AS (SELECT min(url) AS node, terms FROM (SELECT url, {SQL_WORDS} AS terms FROM features) WHERE len(terms) > 0 GROUP BY terms),
 t AS (SELECT node, unnest(terms) AS term FROM nodes),
 w AS (SELECT node, term, ln(1 + (SELECT count(*) FROM nodes) / n) AS w FROM t JOIN (SELECT term, count(*) AS n FROM t GROUP BY 1) USING (term)),
 v AS (SELECT node, term, w / sqrt(sum(w * w) OVER (PARTITION BY node)) AS w FROM w),
 s AS (SELECT x.node AS a, y.node AS b, round(round(sum(x.w * y.w) * 1000000) / 1000) AS similarity FROM v x JOIN v y ON x.term = y.term AND x.node < y.node GROUP BY 1, 2 HAVING round(sum(x.w * y.w) * 1000000) >= {ALIKE} * 1000000)
 SELECT a, b, similarity::BIGINT AS similarity FROM s""")
def similar_listings(spark, sf):
    """Pairs of listings whose words are alike, in thousandths; listings with the same words are one."""
    found = similarity.links(similarity.weighted(similarity.nodes(_words(spark, sf), "url", "terms")), ALIKE)
    return found.select("a", "b", F.round(F.col("similarity") / 1000).cast("long").alias("similarity"))


@query("natural_clusters")
def natural_clusters(spark, sf):
    return similarity.clusters(_words(spark, sf), "url", "terms", ALIKE)
