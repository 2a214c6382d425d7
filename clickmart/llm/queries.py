"""Registered queries of this subpackage: ``opN_<name>`` -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clickmart.llm import (
    bpe,
    exact_dedup,
    html_extract,
    language_id,
    line_dedup,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    ranked_search,
    sharding,
    simhash,
    substring_dedup,
)
from clickmart.llm.common import let

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.classify(
        documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed_lines", "text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(documents(spark, sf_dir))
    spans = F.coalesce("removed_spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.size(spans).alias("n_removed_spans"), removed.alias("removed_bytes"),
        F.transform(spans, lambda s: s["start"]).alias("span_starts"),
        F.transform(spans, lambda s: s["end"]).alias("span_ends"), "text",
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_dedup(documents(spark, sf_dir), shingle=3, radius=3)
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), digests=True)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, sf_dir), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(documents(spark, sf_dir))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the id, in every document with h % 10 = 0 each word from
    place a on becomes word a + (i - a) % p, where g = h / 10, a = g % n and
    p = 1 + (n - a) / (3 + g % 8) (whole numbers). Null ids are left as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10)

    def repeated(ws):
        n = F.size(ws)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        period = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        return let(F.struct(ws.alias("ws"), a.alias("a"), period.alias("p")), lambda s: F.array_join(F.transform(
            s["ws"], lambda w, i: F.when(i < s["a"], w).otherwise(F.get(s["ws"], s["a"] + (i - s["a"]) % s["p"]))), " "))

    return docs.select("doc_id", F.when(h % 10 == 0, let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_periods(documents(spark, sf_dir)))
    # The first run of the greatest exponent; runs come by start, then period.
    best = F.aggregate("runs", F.lit(None).cast(periodic_runs.RUN), lambda top, r: F.when(
        top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_line_dedup": op2_line_dedup,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_language_id": op4_language_id,
        "op5_quality_rules": op5_quality_rules,
        "op6_simhash": op6_simhash,
        "op7_bpe": op7_bpe,
        "op8_sharding": op8_sharding,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_packing": op10_packing,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_html_extract": op12_html_extract,
        "op13_ranked_search": op13_ranked_search,
        "pipeline": corpus_pipeline.run,
    }


ORACLE_SQL = {
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER g AS keep_id,
               count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_ranked_search": r"""
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        counted AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
        whole AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS terms FROM found),
        lengths AS (
            SELECT doc_id, 10 + (90 * count(*) * any_value(w.docs)) // any_value(w.terms) AS m
            FROM found, whole w GROUP BY doc_id
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(w.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counted, whole w GROUP BY term
        ),
        wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        scored AS (
            SELECT item_id, doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id)
            GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 10
    """,
}


def statements() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLE_SQL, **pipeline}
