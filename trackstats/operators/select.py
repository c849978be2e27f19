"""The filtered view every chart query starts from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import vocab


def feature_bound(df: DataFrame, feature: str) -> tuple[Column, Column]:
    """Fixed bounds where the feature has them, else one scalar aggregate of the table."""
    low, high, default = vocab.FEATURE_BOUNDS.get(feature, vocab.OPEN_BOUNDS)
    value = F.when(S.present(feature), F.col(feature))

    def bound(fixed, aggregate, fallback: float) -> Column:
        if fixed is not None:
            return F.lit(fixed)
        found = df.agg(aggregate(value).cast("double")).scalar()
        return F.coalesce(F.nullif(found, F.lit(0.0)), F.lit(fallback))

    return bound(low, F.min, 0.0), bound(high, F.max, default)


def feature_bounds(df: DataFrame, features: list[str], fixed: dict[str, tuple] | None = None) -> list[tuple[Column, Column]]:
    """The bounds of several features from one aggregate of the table."""
    known = {f: (fixed or {}).get(f) or vocab.FEATURE_BOUNDS.get(f, vocab.OPEN_BOUNDS) for f in features}
    parts = []
    for i, f in enumerate(features):
        value = F.when(S.present(f), F.col(f))
        parts += [F.min(value).cast("double").alias(f"low{i}"), F.max(value).cast("double").alias(f"high{i}")]
    found = df.agg(F.struct(*parts)).scalar()

    def bound(value, at: str, fallback: float) -> Column:
        return F.lit(value) if value is not None else F.coalesce(F.nullif(found[at], F.lit(0.0)), F.lit(fallback))
    return [(bound(known[f][0], f"low{i}", 0.0), bound(known[f][1], f"high{i}", known[f][2])) for i, f in enumerate(features)]


def within_band(df: DataFrame, feature: str, target: float, *, bounds_from: DataFrame | None = None,
                tolerance: float = 0.15) -> Column:
    """Predicate: normalised distance to the target is within the tolerance.

    A slightly wider range on the raw column is added so that Parquet statistics
    can skip row groups; it never decides a row by itself.
    """
    source = df if bounds_from is None else bounds_from
    low, high, _ = vocab.FEATURE_BOUNDS.get(feature, vocab.OPEN_BOUNDS)
    lo, hi = feature_bound(source, feature)
    close = F.abs(S.min_max(feature, lo, hi) - S.min_max(F.lit(float(target)), lo, hi)) <= tolerance
    if low is None or high is None:
        return close
    reach = (tolerance + 1e-6) * (high - low)
    return F.col(feature).between(target - reach, target + reach) & close


@dataclass(frozen=True)
class Selection:
    """Year, topic, tolerance bands and word category; None switches a filter off."""

    year: int | None = None
    topic: str | None = None
    bands: dict[str, float | None] = field(default_factory=dict)
    word_category: str | None = None

    def tracks(self, df: DataFrame, *, year: str = "Year", topic: str = "Topic") -> DataFrame:
        out = df
        if self.year is not None:
            out = out.where(F.col(year) == self.year)
        if self.topic is not None:
            out = out.where(F.col(topic) == self.topic)
        for feature, target in self.bands.items():
            if target is not None:
                out = out.where(within_band(out, feature, target, bounds_from=df))
        return out

    def words(self, df: DataFrame, *, year: str = "Year", category: str = "Category") -> DataFrame:
        out = df
        if self.year is not None:
            out = out.where(F.col(year) == self.year)
        if self.word_category is not None:
            out = out.where(F.col(category) == self.word_category)
        return out


def valid_numbers(df: DataFrame, columns: list[str], positive: list[str] = ()) -> DataFrame:
    """Rows with a number in every listed column, and above zero where asked."""
    for c in columns:
        df = df.where(S.present(c))
    for c in positive:
        df = df.where(F.col(c) > 0)
    return df


def drill_down(df: DataFrame, **values) -> DataFrame:
    """Rows with the given column values."""
    for name, value in values.items():
        df = df.where(F.col(name) == value)
    return df


def only_language(df: DataFrame, code: str = "en", column: str = "language") -> DataFrame:
    """Rows in one language when the table has a language column, else all rows."""
    return df.where(F.col(column) == code) if column in df.columns else df
