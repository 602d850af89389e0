"""Canonical values of enumerations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakework.functions.text import normalise_key, python_strip


def _lookup(synonyms: Mapping[str, str]) -> Column:
    entries = [F.lit(x) for key, value in synonyms.items() for x in (key, value)]
    return F.map_from_arrays(F.transform(F.array(*entries[::2]), normalise_key), F.array(*entries[1::2]))


def canonical(value: Column, synonyms: Mapping[str, str]) -> Column:
    """The canonical form of a value whose normal key is a synonym's; others come back stripped, null as null."""
    if not synonyms:
        return python_strip(value)
    return F.coalesce(F.try_element_at(_lookup(synonyms), normalise_key(value)), python_strip(value))


def canonical_list(values: Column, synonyms: Mapping[str, str]) -> Column:
    """``canonical`` of each item of an array."""
    return F.transform(values, lambda v: canonical(v, synonyms))
