"""Name standardization driven by rule data, so that one function serves every list of names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart import reference_values as ref

# Fixed value: characters that do not count when two spellings are compared.
KEY_NOISE = r"[\s_./\-]+"

@dataclass(frozen=True)
class NameRules:
    """Ordered text repairs, then an alias table."""

    steps: Sequence[tuple[str, str]]
    aliases: Mapping[str, str] = field(default_factory=dict)


# Prefix and suffix go in one pass; inner blanks go last, after doubled marks have been repaired.
DISTRICT_RULES = NameRules(
    steps=(
        (f"{ref.DISTRICT_PREFIX}|{ref.CITY_SUFFIX}", ""), ref.SPLIT_VOWEL, ref.DOUBLED_MARK, (r"\s+", ""),
    ),
    aliases=ref.DISTRICT_ALIASES,
)
DENOMINATOR_RULES = NameRules(
    steps=(
        (r"\ufeff", ""), (r"^[\s\u00a0]+|[\s\u00a0]+\z", ""), (ref.LOCAL_OFFICE_PREFIX, ""),
        (f"{ref.DISTRICT_PREFIX}|{ref.CITY_SUFFIX}", ""), ref.SPLIT_VOWEL, ref.DOUBLED_MARK, (r"[\s\u00a0]+", ""),
    ),
    aliases=ref.DENOMINATOR_DISTRICT_ALIASES,
)


def map_literal(values: Mapping[str, str]) -> Column:
    """A dict as a constant map column."""
    return F.create_map(*[F.lit(item) for pair in values.items() for item in pair])


def lookup(value: Column, values: Mapping[str, str]) -> Column:
    """The mapped value, or NULL when there is none. The dict becomes part of the plan; `standardize_by_table` joins a table instead."""
    if not values:
        return F.lit(None).cast("string")
    return F.try_element_at(map_literal(values), value)


def standardize_name(value: Column, rules: NameRules = DISTRICT_RULES) -> Column:
    text = F.trim(value.cast("string"))
    for pattern, replacement in rules.steps:
        plain = not re.search(r"[\\\[(.*+?^$|]", pattern)
        text = F.replace(text, F.lit(pattern), F.lit(replacement)) if plain else F.regexp_replace(text, pattern, replacement)
    return F.coalesce(lookup(text, rules.aliases), text)


def alias_key(value: Column) -> Column:
    """Lower case without blanks and separators."""
    return F.regexp_replace(F.lower(F.trim(value.cast("string"))), KEY_NOISE, "")


def standardize_alias(value: Column, aliases: Mapping[str, str], default: Column | None = None) -> Column:
    """The standard name of a spelling; without one `default`, or else the trimmed original."""
    by_key = {re.sub(KEY_NOISE, "", spelling.lower()): name for spelling, name in aliases.items()}
    fallback = F.trim(value.cast("string")) if default is None else default
    return F.coalesce(lookup(alias_key(value), by_key), fallback)


def age_band(
    age: Column,
    bands: Sequence[tuple[int, str, int | None, int | None]] = ref.AGE_BANDS,
    unknown: int = ref.AGE_BAND_UNKNOWN,
) -> Column:
    """Key of the band holding the whole years of `age`; missing or negative ages are unknown."""
    years = F.floor(age.cast("double"))
    keys = [
        F.when((years >= low) & (F.lit(True) if high is None else years <= high), F.lit(key))
        for key, _, low, high in bands
        if low is not None
    ]
    return F.coalesce(*keys, F.lit(unknown)).cast("int")
