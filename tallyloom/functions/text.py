"""Expressions on offers: brand, model id, projected text, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a model id looks like, and the marks cut out of one.
MODEL_ID_PATTERN = r"[a-zA-Z0-9]*(([0-9]+[^0-9, ]+)|([^0-9, ]+[0-9]+))[a-zA-Z0-9]*"
MODEL_ID_NOISE = ["1080p", "720p", "1080P", "600Hz"]
BRAND_KEYS = ["Brand", "Brand Name"]


def brand_of(features: Column, title: Column) -> Column:
    """Brand feature, else brand name feature, else the first word of the title."""
    named = [F.try_element_at(features, F.lit(k)) for k in BRAND_KEYS]
    first_word = F.nullif(F.regexp_extract(title, r"\S+", 0), F.lit(""))
    return F.coalesce(*named, first_word)


def model_id(title: Column) -> Column:
    """Longest token mixing digits and other signs (the first of equals); null without one.

    A match holds a digit and neither comma nor blank, so the backtracking pattern only has to
    run over the pieces with a digit, in their order.
    """
    pieces = F.filter(F.split(title, "[ ,]"), lambda piece: piece.rlike("[0-9]"))
    found = F.regexp_extract_all(F.array_join(pieces, " "), F.lit(MODEL_ID_PATTERN), F.lit(0))
    longest = F.aggregate(
        found, F.lit(None).cast("string"),
        lambda best, t: F.when(best.isNull() | (F.length(t) > F.length(best)), t).otherwise(best))
    for mark in MODEL_ID_NOISE:
        longest = F.replace(longest, F.lit(mark), F.lit(""))
    return longest


def projected(descriptors: list[Column], features: Column | None = None,
              wanted: list[str] | None = None) -> Column:
    """Chosen descriptors and features as a list without the absent ones; null when empty."""
    parts = F.array(*descriptors)
    if features is not None:
        values = (
            F.map_values(features) if wanted is None
            else F.array(*[F.try_element_at(features, F.lit(k)) for k in wanted])
        )
        parts = F.concat(parts, values)
    present = F.filter(parts, lambda x: x.isNotNull())
    return F.when(F.size(present) > 0, present)


def joined_text(parts: Column) -> Column:
    return F.array_join(parts, " ")


def tokens(text: Column) -> Column:
    """Distinct lower-case words of the whole text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[ \n\r\t]+"), lambda w: w != ""))


# Blocking texts by name; each takes (title, features).
BLOCKING_TEXT: dict[str, Callable[[Column, Column], Column]] = {
    "title": lambda title, features: title,
    "brand": lambda title, features: brand_of(features, title),
    "model_id": lambda title, features: model_id(title),
    "everything": lambda title, features: joined_text(projected([title], features)),
}


def blocking_text(names: list[str], title: Column, features: Column) -> Column:
    return F.concat_ws(" ", *[BLOCKING_TEXT[n](title, features) for n in names])
