"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    inner_products,
    language_id,
    near_dedup,
    neighbours,
    packing,
    phrases,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    vector_codes,
    warc,
)
from .common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.page_records(warc.read_archives(spark, files, payload=False))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trips(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removed(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest)


def op13_largest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.largest_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_near_dedup": op7_near_dedup,
    "op8_neighbours": op8_neighbours,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_phrases": op11_phrases,
    "op12_vector_codes": op12_vector_codes,
    "op13_largest_products": op13_largest_products,
}


def _codes_sql(rounds: int = 4) -> str:
    """Distances as |a|^2 - 2ab + |b|^2 of whole numbers below 2^53; ``256 * distance + entry`` finds the lowest nearest entry."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
    near{i} AS MATERIALIZED (
        SELECT rid, part, min(256 * (list_inner_product(a, a) - 2 * list_inner_product(a, b) + list_inner_product(b, b))::BIGINT + entry) AS best
        FROM parts JOIN book{i} USING (part) GROUP BY rid, part)""")
        if i < rounds:
            steps.append(f"""
    sums{i} AS (
        SELECT part, best % 256 AS entry, pos, floor(sum(x) / count(*)) AS x
        FROM (SELECT n.part, n.best, unnest(a) AS x, generate_subscripts(a, 1) AS pos FROM near{i} n JOIN parts p ON p.rid = n.rid AND p.part = n.part)
        GROUP BY part, entry, pos),
    book{i + 1} AS MATERIALIZED (
        SELECT o.part, o.entry, coalesce(n.b, o.b) AS b FROM book{i} o LEFT JOIN (
            SELECT part, entry, list(x ORDER BY pos) AS b FROM sums{i} GROUP BY part, entry) n ON n.part = o.part AND n.entry = o.entry)""")
    return f"""
WITH vectors AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT rid, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS a FROM vectors, range(4) t(part)),
    book0 AS MATERIALIZED (SELECT part, rid AS entry, a AS b FROM parts WHERE rid < 256),{",".join(steps)},
    coded AS (
        SELECT vec_id, label, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error
        FROM near{rounds} JOIN vectors USING (rid) GROUP BY rid, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos))
        FROM (SELECT part, entry, unnest(b) AS x, generate_subscripts(b, 1) AS pos FROM book{rounds})) AS codebooks_sha256
FROM coded
"""


PHRASES_SQL = r"""
WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
        FROM documents),
    words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
    counts AS MATERIALIZED (
        SELECT lang, words, phrase, count(*) AS f
        FROM (SELECT lang, k AS words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
              FROM words, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k)
        GROUP BY lang, words, phrase),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang),
    split AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
    cuts AS (
        SELECT s.lang, s.phrase, s.f AS a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * s.f * s.f) // (l.f::HUGEINT * r.f) AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM split) s
        JOIN counts l ON l.lang = s.lang AND l.phrase = array_to_string(w[1 : k], ' ') AND l.words = k
        JOIN counts r ON r.lang = s.lang AND r.phrase = array_to_string(w[k + 1 :], ' ') AND r.words = s.words - k),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (
        SELECT lang, phrase, max(f) AS f
        FROM (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, f FROM split WHERE words = 3)
        GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best b JOIN total USING (lang) LEFT JOIN longer USING (lang, phrase)
WHERE longer.f IS NULL OR 100 * longer.f < 50 * a
QUALIFY rank <= 2000
"""

PRODUCTS_SQL = """
WITH vectors AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scores
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {"op11_phrases": PHRASES_SQL, "op12_vector_codes": _codes_sql(), "op13_largest_products": PRODUCTS_SQL}
