"""Raw event CSVs (S1–S5, S7, S8) and metric Parquet datasets.

Layout: ``<base>/year=YYYY/month=MM/day=DD/<event_type>.csv``, each file with a header line
of its own. Files may carry columns that we don't know, in any order.

One scan reads all files as lines and stages them as Parquet on the shared storage, so the
raw bytes are read once, however often validation and cleaning come back to the rows. Lines
become records (``csv_records``: quoted cells may hold line breaks). The first record of each
file is its header (a partial aggregate over the files' first blocks). It is joined to the file's
records, which are cut into cells and mapped to columns by name. The number of different
headers doesn't matter, and no list of paths is built.

Every row keeps its file (``source_file``), split offset and a read-order id, which give the
row's position inside its file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions.columns import na_to_null, parse_number
from clickmart.operators.quality import check_rows, infer_event_type, missing_fields
from clickmart.plans.joins import join_small
from clickmart.schema import KNOWN_COLUMNS, TYPED_COLUMNS
from clickmart.session import scratch_dir
from clickmart.sources.csv_records import cells, records, with_moves


@dataclass
class RawEvents:
    """Raw rows (known columns as strings, ``header`` = the file's column names) and one row
    per file; ``rows`` is None when no file matched."""

    rows: DataFrame | None
    files: DataFrame


def event_paths(base: str, dates: list[str] | None = None, pattern: str = "*.csv") -> list[str]:
    """glob(s) for all days, or only the given ``YYYY-MM-DD`` days (the
    directory names carry the date, so other days are never listed)."""
    base = base.rstrip("/")
    if not dates:
        return [f"{base}/year=*/month=*/day=*/{pattern}"]
    out = []
    for d in dates:
        y, m, dd = d.split("-")
        out.append(f"{base}/year={y}/month={m}/day={dd}/{pattern}")
    return out


def header_names(line: Column, width: int) -> Column:
    return F.transform(cells(F.regexp_replace(line, "^\ufeff", ""), width), lambda t: F.trim(t))


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Globs that match at least one file (a day with no file is not an error)."""
    keep = []
    for p in paths:
        try:
            spark.read.format("binaryFile").load(p)  # lists, reads nothing
            keep.append(p)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return keep


def _normal_path(c: Column) -> Column:
    """``file:///x``, ``file:/x`` -> ``file:/x`` so listing and row metadata agree."""
    return F.regexp_replace(c, r"^file:/+", "file:/")


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every file matched by ``paths`` with its size, as a distributed listing (the
    binary-file source with ``content`` pruned reads no file bytes; files of zero bytes are
    not listed, as in Spark's other file sources)."""
    return (
        spark.read.format("binaryFile")
        .load(paths)
        .select(_normal_path(F.col("path")).alias("source_file"), F.col("length").alias("file_size"))
    )


def _stage(df: DataFrame, label: str) -> DataFrame:
    path = f"{scratch_dir(df.sparkSession, label)}/rows"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_raw(
    spark: SparkSession,
    base: str | None = None,
    dates: list[str] | None = None,
    paths: list[str] | None = None,
    pattern: str = "*.csv",
) -> RawEvents:
    """Raw rows of every event file under ``base`` (or the given ``paths``).

    ``pattern`` is the file glob inside a day directory. The staged lines and the file list
    lie in scratch folders (``session.clear_scratch`` deletes them).
    """
    paths = _existing(spark, event_paths(base, dates, pattern)) if paths is None else paths
    if not paths:
        return RawEvents(None, spark.createDataFrame(
            [], "source_file string, file_size long, file_name string, header array<string>, "
                "first_row long, event_type string"))
    reader = spark.read.option("recursiveFileLookup", "false")
    if base:
        reader = reader.option("basePath", base)
    lines = _stage(
        with_moves(reader.text(paths).select(
            _normal_path(F.col("_metadata.file_path")).alias("source_file"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_id"),
            "value",
        )),
        "raw-lines",
    )
    lines = records(lines)
    # The first record of a file lies in its first block; the aggregate runs map-side.
    first = lines.where("block_start = 0").groupBy("source_file").agg(
        F.min("row_id").alias("first_row"), F.min_by("value", "row_id").alias("line"))
    first = _stage(first, "raw-headers")
    commas = F.length("line") - F.length(F.replace("line", F.lit(","), F.lit("")))
    width = (first.agg(F.max(commas)).first()[0] or 0) + 1  # no header has more cells
    files = _stage(
        list_files(spark, paths).join(first, "source_file", "left").select(
            "source_file", "file_size",
            F.regexp_extract("source_file", r"([^/]*)$", 1).alias("file_name"),
            F.coalesce(header_names(F.col("line"), width), F.array().cast("array<string>")).alias("header"),
            "first_row",
            infer_event_type(F.col("source_file")).alias("event_type"),
        ),
        "raw-files",
    )
    rows = join_small(lines, files.select("source_file", "header", "first_row", "event_type"), ["source_file"], "inner")
    rows = rows.where((F.col("block_start") != 0) | (F.col("row_id") != F.col("first_row")))
    rows = rows.withColumn("__cells", cells(F.col("value"), width))
    rows = rows.select(
        # a name that the header hasn't got has position 0, and cell -1 is null
        *[na_to_null(F.get("__cells", (F.array_position("header", c) - 1).cast("int"))).alias(c) for c in KNOWN_COLUMNS],
        "source_file", "file_size", "block_start", "row_id", "header", "event_type",
    )
    return RawEvents(rows, files)


def check_raw(raw: RawEvents) -> tuple[DataFrame | None, DataFrame]:
    """V1–V12 on raw rows: each row is checked against the columns of its own file. Returns
    (checked rows, files with missing fields)."""
    files = raw.files.withColumn("missing_fields", missing_fields(F.col("header"), F.col("event_type")))
    checked = None if raw.rows is None else check_rows(raw.rows, header="header")
    return checked, files


def typed_events(rows: DataFrame) -> DataFrame:
    """C6 on raw text: the full wide event schema (absent columns become typed NULLs),
    numbers parsed leniently (junk -> NULL). The timestamp stays text until after
    de-duplication (C3 parses it)."""
    out = []
    for name, dtype in TYPED_COLUMNS.items():
        if name == "timestamp":
            dtype = T.StringType()
        if name not in rows.columns:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif isinstance(dtype, (T.DoubleType, T.LongType)):
            out.append(parse_number(F.col(name)).cast(dtype).alias(name))
        else:
            out.append(F.col(name).cast(dtype).alias(name))
    extra = [F.col(c) for c in rows.columns if c not in TYPED_COLUMNS]
    return rows.select(*out, *extra)


def read_metric(
    spark: SparkSession, base: str, metric: str, date: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A metric dataset, pruned to one ``date=`` partition when given. With a
    ``schema`` an empty dataset (no files) reads as an empty frame."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(f"{base.rstrip('/')}/{metric}")
    if date is not None:
        df = df.where(F.col("date") == F.lit(date).cast("date"))
    return df
