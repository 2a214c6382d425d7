from clickmart.functions.columns import (
    blank_or_null,
    na_to_null,
    numeric_text,
    parse_number,
    safe_pct,
    stable,
    uuid_like,
)

__all__ = ["blank_or_null", "na_to_null", "numeric_text", "parse_number", "safe_pct", "stable", "uuid_like"]
