"""Scalar expressions. Missing is null, never NaN or infinity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Date layouts of the input files, as Spark patterns.
DATE_LAYOUTS = {
    "year-month": "yyyy-MM",
    "yearmonth": "yyyyMM",
    "month-name": "MMM-yyyy",
    "year-M-month": "yyyy'M'MM",
    "day-first": "dd/MM/yyyy",
    "month-first": "MM/dd/yyyy",
    "year": "yyyy",
}


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; a zero or missing denominator gives null."""
    return F.try_divide(_col(numerator), _col(denominator))


def unit_price(value: Column | str, quantity: Column | str) -> Column:
    return ratio(value, quantity)


def parse_date(text: Column | str, layout: str) -> Column:
    """Date of a text in one of ``DATE_LAYOUTS``; unparsable text gives null."""
    return F.try_to_date(_col(text), DATE_LAYOUTS[layout])


def next_month_start(date: Column | str) -> Column:
    """Month end plus one day."""
    return F.date_add(F.last_day(_col(date)), 1)


def to_number(text: Column | str, decimal_comma: bool = False) -> Column:
    """Double of a text; bad text gives null."""
    raw = _col(text)
    if decimal_comma:
        raw = F.regexp_replace(raw, ",", ".")
    return raw.try_cast("double")


def to_moment(text: Column | str) -> Column:
    """Timestamp of a text; bad text gives null."""
    return F.try_to_timestamp(_col(text))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def zeros_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero means unknown in the panel: turn 0 into null in all numeric columns."""
    return df.withColumns(
        {c: F.nullif(F.col(c), F.lit(0)) for c in (columns or numeric_columns(df))}
    )


def nulls_to_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=columns or numeric_columns(df))


def replace_sentinel(column: Column | str, sentinel: str = "..", by: str = "0") -> Column:
    c = _col(column)
    return F.when(c == sentinel, F.lit(by)).otherwise(c)


def log_base(column: Column | str, base: float = math.e, offset: float = 1e-8) -> Column:
    return F.log(_col(column) + F.lit(offset)) / F.lit(math.log(base))


def pow_base(column: Column | str, base: float = math.e, offset: float = 0.0) -> Column:
    """Inverse of ``log_base``; the window form of the inverse adds the offset 1e-8."""
    return F.pow(F.lit(float(base)), _col(column) + F.lit(offset))


def above(x: Column | str, knot: float) -> Column:
    """max(x - knot, 0)"""
    return F.greatest(_col(x) - F.lit(knot), F.lit(0.0))


def below_cubed(x: Column | str, knot: float) -> Column:
    """min(x - knot, 0) cubed"""
    return F.pow(F.least(_col(x) - F.lit(knot), F.lit(0.0)), F.lit(3.0))


def category_of(code: Column | str, categories: dict) -> Column:
    """Look up a small fixed code table; unknown codes give null."""
    pairs = [F.lit(v) for kv in categories.items() for v in kv]
    return F.try_element_at(F.create_map(*pairs), _col(code))


def drop_labels_with(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(~F.col(column).contains(part))


def drop_groups_with_bad_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Remove every row of a key that holds any value that is not a number."""
    bad = df.filter(F.col(value).try_cast("double").isNull()).select(key).distinct()
    return df.join(bad, key, "left_anti")


def normal_density(u: Column, bandwidth: float | Column = 1.0) -> Column:
    h = bandwidth if isinstance(bandwidth, Column) else F.lit(float(bandwidth))
    scaled = u / h
    return F.exp(F.lit(-0.5) * scaled * scaled) / (F.lit(math.sqrt(2 * math.pi)) * h)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
