"""Exact dedup (operator 9): stateful streaming over content digests.

The documents' digests are a stream. Its keyed state lies on disk (RocksDB state store,
checkpointed to the shared folder), has no watermark and so never expires, and keeps for
each digest the largest id, that row's content locator and the number of rows. Each
micro-batch writes the entries that it changed to a folder of its own, which a retried batch
replaces. Rows whose digest is held by another row are hits: their text is fetched by
locator and compared with the holder's, byte for byte, so a digest collision can't drop a
document. All of it is DataFrame work; no Python runs on the executors.

Defined results: a null text counts as empty; equal texts are identical strings; of equal
texts the row with the largest id stays (null ids lose; among rows with the same id the one
with the largest locator stays, so exactly one row of a group is kept); empty tables give an
empty result; other columns are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import FILE, LOCATOR, ROW, plain_text, spread_join, stored, with_locator
from clickmart.session import clear_scratch, scratch_dir, scratch_mark

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # no pre-allocated files: there is one store for each shuffle partition, most are small
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _state_stream(intake: DataFrame, path: str, max_files_per_trigger: int | None) -> DataFrame:
    """Run the stream over the stored intake; its last state as rows (digest, holder, n)."""
    spark = intake.sparkSession
    root = scratch_dir(spark, "llm-exact-state")
    reader = spark.readStream.schema(intake.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    state = reader.parquet(path).groupBy("digest").agg(
        F.max(F.struct("id", *LOCATOR)).alias("holder"), F.count(F.lit(1)).alias("n")
    )

    def emit(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/changes/batch={batch}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (
            state.writeStream.outputMode("update").foreachBatch(emit)
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = f"digest binary, holder {state.schema['holder'].dataType.simpleString()}, n bigint, batch bigint"
    changes = spark.read.schema(schema).parquet(f"{root}/changes")
    return changes.groupBy("digest").agg(F.max_by(F.struct("holder", "n"), "batch").alias("last")).select(
        "digest", "last.holder", "last.n"
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """One row per document: id, its locator, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    ``digest`` maps the text column to a binary key; ``max_files_per_trigger`` bounds a
    micro-batch (None: all that is there)."""
    spark = docs.sparkSession
    base = with_locator(docs)
    texts = base.select(*LOCATOR, plain_text(text_col).alias("text"))
    mark = scratch_mark(spark)
    path = f"{scratch_dir(spark, 'llm-exact-intake')}/rows"
    base.select(F.col(id_col).alias("id"), *LOCATOR, digest(plain_text(text_col)).alias("digest")).write.parquet(path)
    intake_schema = base.select(F.col(id_col).alias("id"), *LOCATOR, F.lit(b"").alias("digest")).schema
    intake = spark.read.schema(intake_schema).parquet(path)
    if intake.isEmpty():
        return _result(intake.select("*", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                     F.lit(True).alias("kept")), id_col)

    state = _state_stream(intake, path, max_files_per_trigger)
    held = F.col(f"holder.{FILE}").eqNullSafe(F.col(FILE)) & F.col(f"holder.{ROW}").eqNullSafe(F.col(ROW))
    rows = stored(spread_join(intake, state, ["digest"]).withColumn("kept", held), "llm-exact-rows")
    clear_scratch(spark, mark, keep_last=True)  # the intake and the state, now in the rows

    # Hits: rows that share a digest. Only their texts are compared.
    shared = texts.join(rows.where("n > 1").select("digest", "kept", *LOCATOR), list(LOCATOR))
    holders = shared.where("kept").select("digest", F.col("text").alias("held_text"))
    compared = spread_join(shared.where("not kept"), holders, ["digest"], rows.where("n > 1 and not kept"))
    unequal = stored(
        compared.where("text != held_text")
        .select("digest", *LOCATOR, F.sha2(F.col("text").cast("binary"), 512).alias("content"), "text"),
        "llm-exact-collisions",
    )
    if unequal.isEmpty():
        return _result(rows.withColumn("keep_id", F.col("holder.id")).withColumn("group_size", F.col("n")), id_col)
    return _result(_split_collisions(rows, unequal), id_col)


def _split_collisions(rows: DataFrame, unequal: DataFrame) -> DataFrame:
    """Rows whose bytes differ from the holder's form groups of their own, by whole text."""
    apart = unequal.join(rows.select("id", *LOCATOR), list(LOCATOR))
    groups = apart.groupBy("digest", "content", "text").agg(
        F.max(F.struct("id", *LOCATOR)).alias("holder"), F.count(F.lit(1)).alias("n")
    )
    held = F.struct("id", *LOCATOR).eqNullSafe(F.col("holder"))
    moved = apart.join(groups, ["digest", "content", "text"]).select(
        "digest", "id", *LOCATOR, "holder", "n", held.alias("kept")
    )
    gone = unequal.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    rest = rows.join(unequal.select(*LOCATOR), list(LOCATOR), "left_anti").join(gone, "digest", "left").select(
        "digest", "id", *LOCATOR, "holder", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"), "kept"
    )
    return rest.unionByName(moved).withColumn("keep_id", F.col("holder.id")).withColumn("group_size", F.col("n"))


def _result(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(F.col("id").alias(id_col), *LOCATOR, "keep_id", "group_size", "kept", "digest")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; columns as they came."""
    base = with_locator(docs)
    dropped = exact_dedup(base, id_col, text_col).where("not kept").select(*LOCATOR)
    return base.join(dropped, list(LOCATOR), "left_anti").drop(*LOCATOR)
