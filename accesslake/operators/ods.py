"""ODS layer: raw lines -> typed, cleaned rows plus rejected lines.

A line is kept when it has at least 11 tab-separated fields (extra fields are
ignored, trailing empty fields count) and its responseSize parses as a whole
number other than the dirty marker -1. Every other line goes to the rejects
with reason `short` or `dirty_size`; no line fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake.functions.parse import (
    DIRTY_SIZE,
    FIELD_SEP,
    REASON_DIRTY,
    REASON_SHORT,
    field,
    long_or,
    raw_field_columns,
    split_fields,
    text_line,
)
from accesslake.schemas import GOOD, KIND, N_RAW_FIELDS, ODS_COLS, RAW_FIELDS, REJECTED

REASON = "reason"
N_FIELDS = "n_fields"


def raw_fields(raw: DataFrame, value: str = "value") -> DataFrame:
    """Every raw line split into its field count and 11 named string fields.

    Missing fields are NULL; the line itself is kept as `value`.
    """
    fields = split_fields(F.col(value))
    return raw.select(
        F.col(value).alias("value"),
        F.size(fields).cast("bigint").alias(N_FIELDS),
        *raw_field_columns(fields),
    )


def tag(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw lines with typed ODS columns and a `reason` (NULL for good rows)."""
    fields = split_fields(F.col(value))
    n = F.size(fields)
    size = long_or(field(fields, RAW_FIELDS.index("responseSize")), DIRTY_SIZE)
    cols: list[Column] = [
        size.alias(name) if name == "responseSize" else field(fields, i).alias(name)
        for i, name in enumerate(RAW_FIELDS)
    ]
    reason = (
        F.when(n < N_RAW_FIELDS, F.lit(REASON_SHORT))
        .when(size == F.lit(DIRTY_SIZE), F.lit(REASON_DIRTY))
    )
    return raw.select(F.col(value).alias("value"), *cols, reason.alias(REASON))


def good(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).select(*ODS_COLS)


def rejects(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull()).select("value", REASON)


def by_kind(tagged: DataFrame) -> DataFrame:
    """Every tagged row with its kind, for one write of both kinds.

    A good row has its ODS columns and no line, a rejected one its line and reason
    and no ODS columns.
    """
    is_good = F.col(REASON).isNull()
    kind = F.when(is_good, F.lit(GOOD)).otherwise(F.lit(REJECTED))
    fields = [F.when(is_good, F.col(c)).alias(c) for c in ODS_COLS]
    return tagged.select(*fields, F.when(~is_good, F.col("value")).alias("value"), REASON, kind.alias(KIND))


def clean(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(ods rows, rejected lines `value, reason`)."""
    t = tag(raw, value)
    return good(t), rejects(t)


def count_columns() -> list[Column]:
    """Aggregates of a tagged frame: total, good, short and dirty_size rows."""
    r = F.col(REASON)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(r.isNull()).alias("good"),
        F.count_if(r == F.lit(REASON_SHORT)).alias("short"),
        F.count_if(r == F.lit(REASON_DIRTY)).alias("dirty_size"),
    ]


def counts(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row: total, good, short, dirty_size."""
    return tag(raw, value).agg(*count_columns())


def text_lines(ods_rows: DataFrame) -> DataFrame:
    """ODS rows as V1 text lines: the 11 fields, tab-separated, plus a trailing tab.

    Read back with `clean`, the trailing tab is a 12th (empty) field, which is
    ignored, so the rows come back unchanged.
    """
    return ods_rows.select(F.concat(text_line(*ODS_COLS), F.lit(FIELD_SEP)).alias("value"))
