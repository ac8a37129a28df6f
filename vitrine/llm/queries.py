"""The queries of this package: one for each operator with production parameters, over whole tables, and the pipeline.

`CHECKS` holds SQL for those that SQL can express at a bearable cost; the others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (
    alignment,
    bpe,
    class_lm,
    decontaminate,
    fertility,
    jaccard,
    quality,
    secrets,
    substrings,
    token_counts,
    top_k,
    toxicity,
    whitening,
)
from vitrine.llm.rows import crc_column, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if check is not None:
            CHECKS[name] = check
        return build

    return register


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


_WORDS = f"coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"


@query("op1_decontamination", f"""
    WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    patterns AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS p
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
    docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    found AS (
        SELECT doc_id, i, d.n, item_id
        FROM (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS p
              FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM docs, (SELECT DISTINCT n FROM patterns))) d
        JOIN patterns p ON p.p = d.p AND p.n = d.n),
    hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(texts(spark, folder), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.digest("items").alias("items_sha256"), "contaminated",
    )


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(texts(spark, folder), str(path)).drop("text")


@query("op4_secrets")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(texts(spark, folder))
    of = lambda kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = secrets.KINDS[:3]
    return found.select(
        "doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(base)), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
        F.size(of(["guess"])).cast("long").alias("n_guess"),
    )


@query("op5_bpe_round_trip")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(texts(spark, folder), str(path)).drop("text")


@query("op6_top_k", """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
    WHERE rank <= 5""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def _scored(spark: SparkSession, folder: str, module) -> DataFrame:
    documents = texts(spark, folder)
    model = module.train(documents, table(spark, folder, "labels"))
    parts, held = module.FOLD
    held_out = (crc_column("doc_id") % parts == held).alias("held_out")
    return module.score(documents, model).select("doc_id", held_out, "score", "predicted")


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, toxicity)


@query("op9_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, quality)


@query("op10_ngram_jaccard", f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(len(w), 4)], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 3, 1))) AS i FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    links AS (
        SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id
                          GROUP BY ALL) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * c >= 85 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM docs LEFT JOIN sizes USING (doc_id) JOIN least_id USING (doc_id)""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(texts(spark, folder)).drop("key", "text_hash")


@query("op8_repeated_substrings")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(texts(spark, folder), kept=False)


@query("op7_class_lm")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    parts, held = class_lm.FOLD
    held_out = (crc_column("doc_id") % parts == held).alias("held_out")
    found = class_lm.score(texts(spark, folder))
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _both_vocabularies() -> tuple[str, str]:
    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokens(texts(spark, folder), *_both_vocabularies()).drop("text")


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op13_fertility")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    vocabularies = [str(public_tokenizers.path(name)) for name in ("byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model")]
    return fertility.keep(documents, *vocabularies, language="lang").drop("lang", "size_class")
