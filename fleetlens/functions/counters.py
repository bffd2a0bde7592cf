"""Choice of a counter column per row, and what its change means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params


@dataclass(frozen=True)
class Candidates:
    """Counter columns that match the keywords, in order of preference.

    ``entries`` holds (keyword, column): keywords in the given order and, within a keyword, columns
    in table order.  The fallback entries are the tail that starts at ``fallback_from``.
    """

    entries: tuple[tuple[str, str], ...]
    fallback_from: int

    @classmethod
    def of(
        cls,
        df: DataFrame,
        primary: Sequence[str] = params.PRIMARY_KEYWORDS,
        fallback: Sequence[str] = params.FALLBACK_KEYWORDS,
    ) -> Candidates:
        counters = [name for name in df.columns if name.endswith(params.COUNTER_SUFFIX)]

        def matching(keywords: Sequence[str]) -> list[tuple[str, str]]:
            return [(word, name) for word in keywords for name in counters if word in name]

        first = matching(primary)
        return cls(tuple(first + matching(fallback)), len(first))

    def readings(self, df: DataFrame) -> Column:
        """The known candidate values of a row as an array of (position, value), in order of preference.

        A tool has few of the many counters of a fleet, so the array is short however wide the table.
        """
        if not self.entries:
            return F.array().cast(f"array<struct<position:int,value:{params.COUNTER}>>")
        types = dict(df.dtypes)

        def value(name: str) -> Column:
            column = F.col(f"`{name}`")
            return F.nullif(column, F.lit(float("nan"))) if types[name] in ("float", "double") else column

        numbered = F.transform(
            F.array(*[value(name) for _, name in self.entries]),
            lambda v, position: F.struct(position.alias("position"), v.alias("value")),
        )
        return F.filter(numbered, lambda reading: reading["value"].isNotNull())

    def name(self, position: Column) -> Column:
        return F.get(F.array(*[F.lit(name) for _, name in self.entries]).cast("array<string>"), position)

    def keyword(self, position: Column) -> Column:
        return F.get(F.array(*[F.lit(keyword) for keyword, _ in self.entries]).cast("array<string>"), position)


def pick_counter(readings: Column, candidates: Candidates, fallback_only: bool = False) -> Column:
    """The first reading (position, value) above zero, of all candidates or the fallbacks; null if none."""
    start = candidates.fallback_from if fallback_only else 0
    usable = F.filter(readings, lambda reading: (reading["value"] > 0) & (reading["position"] >= start))
    return F.get(usable, F.lit(0))


def reading_at(readings: Column, position: Column) -> Column:
    """The value of the counter at ``position``, null if it has none."""
    return F.get(F.filter(readings, lambda reading: reading["position"] == position), F.lit(0))["value"]


def counter_change(current: Column, previous: Column) -> Column:
    """Difference to the previous reading, null if either is missing."""
    return current - previous


def is_replacement(change: Column, threshold: float = params.REPLACEMENT_THRESHOLD) -> Column:
    """True when the counter fell by more than the threshold allows."""
    return change < F.lit(threshold)


def number_text(value: Column) -> Column:
    """A reading as text with one or two decimals: 17500.0, 250.25."""
    return F.regexp_replace(value.cast(params.COUNTER).cast("string"), r"(\.\d)0$", "$1")


def calculation_notes(*reasons: Column) -> Column:
    """The reasons that apply, in order, joined by ``'; '``; null if there is none."""
    return F.nullif(F.concat_ws("; ", F.array_compact(F.array(*reasons))), F.lit(""))
