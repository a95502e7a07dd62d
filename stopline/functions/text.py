"""Text, code and level columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopline import schema


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True where any word occurs anywhere; NULL text gives false."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.coalesce(text.rlike(pattern), F.lit(False))


def highway_flag(location: Column) -> Column:
    return contains_any(location, schema.HIGHWAYS)


def major_road_flag(location: Column, repaired: bool = False) -> Column:
    """Road names and numbers in the location.

    By default the entries the original pattern could never reach stay out;
    `repaired=True` uses the whole list.
    """
    unreached = [] if repaired else schema.UNREACHED_ROADS
    return contains_any(location, [r for r in schema.MAJOR_ROADS if r not in unreached])


def extract_code(text: Column, pattern: str = r"\d+-\d\d\d", fallback_len: int | None = 2) -> Column:
    """First match of `pattern`; without one the first characters, or NULL."""
    found = F.regexp_substr(text, F.lit(pattern))
    return found if fallback_len is None else F.coalesce(found, F.substring(text, 1, fallback_len))


def shorten_code(code: Column, pattern: str = r"\d\d-\d") -> Column:
    return extract_code(code, pattern, None)


def in_set(value: Column, allowed: Iterable) -> Column:
    """Membership that is false, never NULL, for NULL."""
    return F.coalesce(value.isin(list(allowed)), F.lit(False))


def region_flag(state: Column, home: Iterable[str] = schema.HOME_REGION) -> Column:
    return F.when(in_set(state, home), "DMV").otherwise("Other")


def map_levels(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace mapped levels; the others stay."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, value), value)


def combine_levels(value: Column, levels: Iterable[str], label: str) -> Column:
    return map_levels(value, {level: label for level in levels})


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")


def binary_label(response: Column, positive: str = "Citation") -> Column:
    return F.when(response == positive, 1.0).otherwise(0.0)


def top_flag(accuracy_decrease: Column, gini_decrease: Column,
             accuracy_cut: float = 0.045, gini_cut: float = 12400.0) -> Column:
    top = (accuracy_decrease > accuracy_cut) | (gini_decrease > gini_cut)
    return F.when(top, "Top").otherwise("Other")


def inv_logit(coefficient: Column, digits: int = 4) -> Column:
    """Probability of a coefficient that is first rounded to `digits` places."""
    return 1.0 / (1.0 + F.exp(-F.round(coefficient, digits)))
