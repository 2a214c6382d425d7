"""File validation (V1–V15): rule table, per-row flags, per-file verdicts, routing.

Rules are plain column expressions, one boolean "invalid" flag per checked field.
A row is invalid when any flag is set; a file is invalid when any row is invalid or a
required column is missing. Everything is a projection plus one aggregation keyed by
file, so the work is spread over all rows of all files; a file holding a third of all rows is
pre-aggregated map-side like any other key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.functions.columns import blank_or_null, parse_number, uuid_like
from clickmart.plans.joins import join_small
from clickmart.schema import CART_ACTIONS, EVENT_TYPES, PAGE_TYPES

Rule = Callable[[Column], Column]


def _not_in(values) -> Rule:
    return lambda c: ~F.coalesce(c.isin(*values), F.lit(False))


def _bad_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string")).isNull()


def _bad_time_on_page(c: Column) -> Column:
    v = parse_number(c)
    return F.coalesce(~v.between(1, 3600), F.lit(True))


def _bad_price(c: Column) -> Column:
    return F.coalesce(~(parse_number(c) > 0), F.lit(True))


def _bad_position(c: Column) -> Column:
    v = parse_number(c)
    return F.coalesce((v < 0) | F.isnan(v % 1) | (v % 1 != 0), F.lit(True))


# V2–V4: rules every event file must pass.
COMMON_RULES: dict[str, Rule] = {
    "user_id": lambda c: ~uuid_like(c),
    "session_id": blank_or_null,
    "timestamp": _bad_timestamp,
}

# Rules by event type (V12 dispatch table). ``search`` has none.
TYPE_RULES: dict[str, dict[str, Rule]] = {
    "page_view": {"page_type": _not_in(PAGE_TYPES), "time_on_page_seconds": _bad_time_on_page},
    "product_view": {"price": _bad_price, "product_id": blank_or_null},
    "cart_event": {"action": _not_in(CART_ACTIONS)},
    "click": {"x_position": _bad_position, "y_position": _bad_position},
    "search": {},
}

CHECKED_FIELDS: tuple[str, ...] = tuple(
    dict.fromkeys([*COMMON_RULES, *[f for rules in TYPE_RULES.values() for f in rules]])
)


def flag(field: str) -> str:
    return f"invalid_{field}"


def infer_event_type(path: Column) -> Column:
    """Event type from the file name (name starts with the type); ``''`` if none.

    Files written by Spark into ``event_type=<t>/`` directories fall back to that
    directory name.
    """
    types = "|".join(EVENT_TYPES)
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    by_name = F.regexp_extract(name, rf"^({types})", 1)
    by_dir = F.regexp_extract(path, rf"event_type=({types})/[^/]*$", 1)
    return F.when(by_name != "", by_name).otherwise(by_dir)


def _lacking(header: Column, fields) -> Column:
    """Names of ``fields`` that the header hasn't got."""
    wanted = F.array(*[F.lit(f) for f in fields]).cast("array<string>")
    return F.array_except(wanted, header)


def missing_fields(header: Column, event_type: Column) -> Column:
    """V1: ``missing_column:<c>`` for each required column that the header hasn't got."""
    typed = F.array().cast("array<string>")
    for t, rules in TYPE_RULES.items():
        if rules:
            typed = F.when(event_type == t, _lacking(header, rules)).otherwise(typed)
    names = F.array_sort(F.array_distinct(F.concat(_lacking(header, COMMON_RULES), typed)))
    return F.transform(names, lambda c: F.concat(F.lit("missing_column:"), c))


def check_rows(
    df: DataFrame,
    event_type_col: str = "event_type",
    columns: dict[str, str] | None = None,
    header: str | None = None,
) -> DataFrame:
    """Add one ``invalid_<field>`` flag per checked field, ``missing_fields`` and ``row_invalid``.

    ``columns`` maps a field name to the physical column holding it (e.g. the raw
    timestamp text). ``header`` names an array column with the column names of the row's
    file; when a rule group's required column is not among them, every row of that group is
    invalid, the group's other rules are skipped, and ``missing_column:<c>`` is reported.
    """
    columns = columns or {}
    et = F.col(event_type_col)
    phys = lambda f: F.col(columns.get(f, f))

    def complete(fields) -> Column:
        return F.lit(True) if header is None else F.size(_lacking(F.col(header), fields)) == 0

    flags: dict[str, Column] = {}
    for field, rule in COMMON_RULES.items():
        flags[field] = complete(COMMON_RULES) & rule(phys(field))
    for t, rules in TYPE_RULES.items():
        for field, rule in rules.items():
            expr = complete(rules) & rule(phys(field))
            flags[field] = F.when(et == t, expr).otherwise(flags.get(field, F.lit(False)))
    missing_expr = (
        F.array().cast("array<string>") if header is None else missing_fields(F.col(header), et)
    )
    out = df.select(
        "*",
        *[flags.get(f, F.lit(False)).alias(flag(f)) for f in CHECKED_FIELDS],
        missing_expr.alias("missing_fields"),
    )
    any_flag = F.lit(False)
    for f in CHECKED_FIELDS:
        any_flag = any_flag | F.col(flag(f))
    return out.withColumn("row_invalid", any_flag | (F.size("missing_fields") > 0))


def file_verdicts(
    checked: DataFrame,
    file_col: str = "file_id",
    event_type_col: str = "event_type",
    size_agg: Column | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per file: status, sorted failed fields, invalid/total rows, bytes.

    ``files`` (file_col, event_type[, missing_fields]) lists every file, so files
    without data rows (header only) still get a verdict.
    """
    size_agg = size_agg if size_agg is not None else F.lit(None).cast("long")
    # Only fixed-width aggregates here, so the plan keeps a hash aggregate.
    per_file = checked.groupBy(file_col, event_type_col).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("row_invalid")).alias("invalid_rows"),
        *[F.max(F.col(flag(f))).alias(f"__any_{f}") for f in CHECKED_FIELDS],
        size_agg.cast("long").alias("file_bytes"),
    )
    if files is None:
        per_file = per_file.withColumn("__missing", F.lit(""))
    else:
        base = files.select(
            file_col, event_type_col,
            (F.array_join("missing_fields", ",") if "missing_fields" in files.columns
             else F.lit("")).alias("__missing"),
            (F.col("file_size").cast("long") if "file_size" in files.columns
             else F.lit(None).cast("long")).alias("__file_size"),
        )
        # One row per file on both sides: a plain shuffle join on the file key.
        per_file = base.join(per_file, [file_col, event_type_col], "left").select(
            file_col, event_type_col,
            F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
            F.coalesce("invalid_rows", F.lit(0)).alias("invalid_rows"),
            *[F.coalesce(f"__any_{f}", F.lit(False)).alias(f"__any_{f}") for f in CHECKED_FIELDS],
            F.coalesce("__file_size", "file_bytes").alias("file_bytes"),
            "__missing",
        )
    failed = F.array_compact(F.array(*[F.when(F.col(f"__any_{f}"), F.lit(f)) for f in CHECKED_FIELDS]))
    missing = F.when(
        F.coalesce(F.col("__missing"), F.lit("")) != "", F.split(F.col("__missing"), ",")
    ).otherwise(F.array().cast("array<string>"))
    failed = F.array_sort(F.array_distinct(F.concat(failed, missing)))
    return per_file.select(
        file_col,
        event_type_col,
        F.when(F.col(event_type_col) == "", F.lit("unknown_event_type"))
        .when((F.col("invalid_rows") > 0) | (F.size(failed) > 0), F.lit("invalid"))
        .otherwise(F.lit("valid")).alias("status"),
        failed.alias("failed_fields"),
        F.col("invalid_rows").cast("long").alias("invalid_rows"),
        F.col("total_rows").cast("long").alias("total_rows"),
        "file_bytes",
    )


def first_invalid_rows(
    checked: DataFrame, order_cols: list[str], file_col: str = "file_id", n: int = 3
) -> DataFrame:
    """The first ``n`` invalid rows of each file, in file order (``sample_rank`` 1..n).

    ``row_number() <= n`` is planned with a map-side group limit, so no file ships more
    than ``n`` rows per task to the shuffle.
    """
    w = Window.partitionBy(file_col).orderBy(*[F.col(c) for c in order_cols])
    return (
        checked.where(F.col("row_invalid"))
        .withColumn("sample_rank", F.row_number().over(w))
        .where(F.col("sample_rank") <= n)
    )


def ingest_metrics(verdicts: DataFrame) -> DataFrame:
    """Files processed (valid), valid records, megabytes of valid files, invalid files."""
    valid = F.col("status") == "valid"
    return verdicts.agg(
        F.count_if(valid).alias("files_processed"),
        F.coalesce(F.sum(F.when(valid, F.col("total_rows"))), F.lit(0)).cast("long").alias("valid_records"),
        (F.coalesce(F.sum(F.when(valid, F.col("file_bytes"))), F.lit(0)) / F.lit(1048576.0)).alias("size_mb"),
        F.count_if(~valid).alias("invalid_files"),
    )


def route(
    rows: DataFrame,
    verdicts: DataFrame,
    file_col: str = "file_id",
    valid: bool = True,
    granularity: str = "file",
) -> DataFrame:
    """Rows of valid files (``valid=True``) or of invalid files (quarantine).

    With ``granularity="row"`` each row is routed by its own flag instead.
    """
    if granularity == "row":
        flag_col = F.col("row_invalid")
        return rows.where(~flag_col if valid else flag_col)
    is_valid = F.col("status") == "valid"
    keys = verdicts.where(is_valid if valid else ~is_valid).select(file_col)
    return join_small(rows, keys, [file_col], "left_semi")


def error_reports(
    verdicts: DataFrame,
    samples: DataFrame,
    sample_cols: list[str],
    file_col: str = "file_id",
) -> DataFrame:
    """K6 content: one row per invalid file with the error type, failed fields and the
    first invalid rows (at most three, so the collected list is bounded)."""
    rows = samples.groupBy(file_col).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("sample_rank"), *[F.col(c) for c in sample_cols]))
        ).alias("__rows")
    )
    bad = verdicts.where(F.col("status") != "valid")
    return bad.join(rows, file_col, "left").select(
        file_col,
        F.when(F.col("status") == "unknown_event_type", F.lit("unknown_event_type"))
        .otherwise(F.lit("validation_error")).alias("error_type"),
        "failed_fields",
        F.coalesce(
            F.transform("__rows", lambda r: r.dropFields("sample_rank")),
            F.array(),
        ).alias("first_invalid_rows"),
    )
