"""Column functions (built-in Spark expressions only)."""

from accesslake.functions.parse import (
    day_from_path,
    long_or,
    parse_long,
    split_fields,
    text_line,
    time_parts,
    url_parts,
)

__all__ = [
    "day_from_path", "long_or", "parse_long", "split_fields", "text_line",
    "time_parts", "url_parts",
]
