"""Helpers shared by the operators of this subpackage.

Row locators: several operators have to join a decision back to its row. ``doc_id`` may be
null or repeated, so they use the place of the row in its Parquet file instead (a 64-bit
key of the file's path and the row's number in it). It is the same in every scan, also when
a lost executor's task runs again. Frames that aren't plain file scans are written to the
shared folder first.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.session import scratch_dir

FILE, ROW = "__loc_file", "__loc_row"
LOCATOR = (FILE, ROW)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, and
    survives the loss of any executor."""
    path = f"{scratch_dir(df.sparkSession, label)}/rows"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_locator(docs: DataFrame) -> DataFrame:
    """``docs`` plus the two locator columns (as they are, if it has them already)."""
    if set(LOCATOR) <= set(docs.columns):
        return docs
    try:
        return _located(docs)
    except AnalysisException:  # not a file scan: no row has a place yet
        return _located(stored(docs, "llm-rows"))


def _located(docs: DataFrame) -> DataFrame:
    meta = docs.metadataColumn("_metadata")
    return docs.select(
        "*", F.xxhash64(meta.getField("file_path")).alias(FILE), meta.getField("row_index").alias(ROW)
    )


SHARE, SALTS = 1000, 64
_SALT, _SALTS = "__salt", "__salts"


def spread_join(
    many: DataFrame, one: DataFrame, on: list[str], counted: DataFrame | None = None,
    share: int = SHARE, salts: int = SALTS,
) -> DataFrame:
    """``many`` joined with ``one``, which has one row for each key at most.

    A key that more than one in ``share`` rows of ``many`` hold is dealt over ``salts`` tasks, and its row
    of ``one`` is repeated for them. There are fewer than ``share`` such keys whatever the
    input, so they can be broadcast. Keys are counted in ``counted``, a stored frame with the same
    keys (None: in ``many``, which should be stored then). Keys aren't null."""
    spark = many.sparkSession
    counted = (many if counted is None else counted).select(*on)
    counts = counted.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = counted.count()
    hot = counts.where(F.col("__n") > max(1.0, total / share)).select(*on).collect()
    if not hot:
        return many.join(one, on)
    hot = F.broadcast(spark.createDataFrame(hot, many.select(*on).schema).withColumn(_SALTS, F.lit(salts)))
    deal = F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int")
    left = many.join(hot, on, "left").withColumn(_SALT, F.when(F.col(_SALTS).isNull(), 0).otherwise(deal)).drop(_SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    right = one.join(hot, on, "left").withColumn(_SALT, F.explode(copies)).drop(_SALTS)
    return left.join(right, [*on, _SALT]).drop(_SALT)


def plain_text(text_col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a variable. Inside the lambdas of
    array functions a plain expression would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file on this machine (each executor resolves its own)."""
    import public_tokenizers

    return public_tokenizers.path(name)
