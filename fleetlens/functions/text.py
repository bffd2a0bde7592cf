"""Names, keys and text-to-number conversion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetlens import params

# An optional sign, digits with at most one point, an optional exponent.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_BIGINT_LIMIT = 9.2e18


def normalize_entity(
    entity: Column,
    pattern: str = params.ENTITY_PATTERN,
    replacement: str = params.ENTITY_REPLACEMENT,
    enabled: bool = True,
) -> Column:
    """Replace every occurrence of ``pattern``; null stays null."""
    return F.replace(entity, F.lit(pattern), F.lit(replacement)) if enabled else entity


def fab_entity_key(fab: Column, entity: Column) -> Column:
    """``FAB_ENTITY`` key.  A missing part is spelled ``nan``."""
    return F.concat_ws("_", F.coalesce(fab, F.lit("nan")), F.coalesce(entity, F.lit("nan")))


def derive_fab(entity: Column) -> Column:
    """The site: text before the first underscore."""
    return F.split_part(entity, F.lit("_"), F.lit(1))


def tool_id(entity: Column, location: Column) -> Column:
    """A tool is an ENTITY at a Location.  A missing part is spelled ``None``."""
    return F.concat_ws("|", F.coalesce(entity, F.lit("None")), F.coalesce(location, F.lit("None")))


def to_int(value: Column) -> Column:
    """Whole number from text, or null for text that is no number and for fractions."""
    text = value.cast("string")
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    whole = (number == F.floor(number)) & (F.abs(number) < _BIGINT_LIMIT)
    return F.coalesce(text.try_cast("bigint"), F.when(whole, number.cast("bigint")))
