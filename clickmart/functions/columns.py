"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmart.schema import NA_TOKENS

# Number forms a lenient numeric parser accepts: integers, decimals, exponents, inf.
_NUMERIC_RE = r"(?i)^\s*[+-]?(inf|infinity|((\d+\.?\d*|\.\d+)(e[+-]?\d+)?))\s*$"
_HEX32_RE = r"^[0-9a-fA-F]{32}$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c) -> Column:
    """Missing-value tokens (``NA``, ``null``, ``NaN``, ``''`` …) become SQL NULL."""
    c = col_of(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def blank_or_null(c) -> Column:
    """True when the text is NULL or only whitespace."""
    c = col_of(c)
    return c.isNull() | c.cast("string").rlike(r"^\s*$")


def numeric_text(c) -> Column:
    """True when the text reads as a number (NULL-safe: NULL -> False)."""
    return F.coalesce(col_of(c).cast("string").rlike(_NUMERIC_RE), F.lit(False))


def parse_number(c) -> Column:
    """Lenient numeric parse: text that does not read as a number gives NULL.

    Spark's own cast also accepts forms like ``'10d'``; the regex guard rejects them.
    """
    c = col_of(c)
    text = F.trim(c.cast("string"))
    return F.when(numeric_text(c), text.try_cast("double"))


def uuid_like(c) -> Column:
    """True when the text is accepted as a UUID.

    Accepts the usual spellings: plain, braces, ``urn:uuid:`` prefix and no hyphens.
    """
    c = col_of(c).cast("string")
    # literal replacements (no regex engine) and a two-sided strip of brace characters
    stripped = F.replace(F.replace(c, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    stripped = F.btrim(stripped, F.lit("{}"))
    stripped = F.replace(stripped, F.lit("-"), F.lit(""))
    return F.coalesce(stripped.rlike(_HEX32_RE), F.lit(False))


def safe_pct(numerator, denominator, scale: float = 100.0) -> Column:
    """numerator / denominator * scale, NULL when the denominator is 0 or NULL."""
    n, d = col_of(numerator), col_of(denominator)
    return F.when(d > 0, n.cast("double") / d.cast("double") * F.lit(scale))


def round_doubles(df, digits: int = 6):
    """Round every double column (result presentation), without the noise of the summation
    order: that goes first, so it can't tip a value between two results."""
    from pyspark.sql import types as T

    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(stable(field.name), digits).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def stable(c, digits: int = 9) -> Column:
    """A mean without the noise of the summation order, for sort keys and decimal casts."""
    return F.round(col_of(c), digits)
