"""The operators and the pipeline as registered queries, with SQL where it can say
the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    importance,
    language_id,
    near_dedup,
    packing,
    personal_data,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; its folder may be set in TOKENIZERS_DIR."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = secret_scan.scan_secrets(
        given(spark, sf_dir, "documents"),
        vocabulary("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    base = F.filter("spans", lambda s: s["kind"] != "random")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    ).drop("_row")


def _span_total(spans: str) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(spans, zero, lambda n, s: n + s["end"] - s["start"])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(given(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        _span_total("removed").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "longest",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(
        given(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(given(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(given(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        _span_total("removed").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(given(spark, sf_dir, "documents")).drop("_row")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(given(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.scan_personal_data(given(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in personal_data.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(plain), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(given(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(
        given(spark, sf_dir, "documents"),
        vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"),
    )


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality": op2_quality,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_personal_data": op11_personal_data,
    "op12_collocations": op12_collocations,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece_id, piece
            FROM (
                SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents
            )
        ), lists AS (
            SELECT lang, piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), suffixes AS (
            SELECT lang, words[k] AS w1, words[k + 1] AS w2, words[k + 2] AS w3
            FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS k FROM lists)
        ), totals AS (
            SELECT lang, count(*) AS n FROM suffixes GROUP BY lang
        ), f1 AS (
            SELECT lang, w1, count(*) AS f FROM suffixes GROUP BY lang, w1
        ), f2 AS (
            SELECT lang, w1, w2, count(*) AS f FROM suffixes WHERE w2 IS NOT NULL
            GROUP BY lang, w1, w2
        ), f3 AS (
            SELECT lang, w1, w2, w3, count(*) AS f FROM suffixes WHERE w3 IS NOT NULL
            GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
        ), inside AS (
            SELECT lang, w1, w2, max(f) AS longest FROM (
                SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3
            ) GROUP BY lang, w1, w2
        ), cuts AS (
            SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, 1 AS k, p.f AS a, x.f AS l, y.f AS r
            FROM f2 p JOIN f1 x ON (x.lang, x.w1) = (p.lang, p.w1)
            JOIN f1 y ON (y.lang, y.w1) = (p.lang, p.w2)
            LEFT JOIN inside i ON (i.lang, i.w1, i.w2) = (p.lang, p.w1, p.w2)
            WHERE p.f >= 10 AND (i.longest IS NULL OR 100 * i.longest < 50 * p.f)
            UNION ALL
            SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, 1, p.f, x.f, y.f
            FROM f3 p JOIN f1 x ON (x.lang, x.w1) = (p.lang, p.w1)
            JOIN f2 y ON (y.lang, y.w1, y.w2) = (p.lang, p.w2, p.w3)
            UNION ALL
            SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, 2, p.f, x.f, y.f
            FROM f3 p JOIN f2 x ON (x.lang, x.w1, x.w2) = (p.lang, p.w1, p.w2)
            JOIN f1 y ON (y.lang, y.w1) = (p.lang, p.w3)
        ), scored AS (
            SELECT *, (1000000 * a::HUGEINT * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
        ), lowest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM lowest
        )
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
