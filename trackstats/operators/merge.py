"""Keyed refresh, merge with reconciliation, column patches, resumable selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .keys import best_per_key, lookup, membership


def refresh(base: DataFrame, fresh: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Base rows with a fresh counterpart, their measures replaced.

    Unmatched base rows are dropped; a key repeated on both sides multiplies.
    NULL keys match. Both inputs are shuffled by the join itself, so AQE can
    split a hot key on either side.
    """
    new = fresh.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                       *[F.col(m).alias(f"__new_{m}") for m in measures])
    on = None
    for i, k in enumerate(keys):
        same = base[k].eqNullSafe(new[f"__k{i}"])
        on = same if on is None else on & same
    joined = base.join(new, on, "inner")
    return joined.select(*[F.col(f"__new_{c}").alias(c) if c in measures else base[c] for c in base.columns])


def unmatched(fresh: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh rows whose key is not in the base."""
    return membership(fresh, base, keys, present=False)


def matched(fresh: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    return membership(fresh, base, keys, present=True)


def in_shared_years(fresh: DataFrame, base: DataFrame, year: str = "Year") -> DataFrame:
    return membership(fresh, base, [year], present=True)


def in_new_years(fresh: DataFrame, base: DataFrame, year: str = "Year") -> DataFrame:
    return membership(fresh, base, [year], present=False)


def new_in_shared_years(fresh: DataFrame, base: DataFrame, keys: list[str], year: str = "Year") -> DataFrame:
    return unmatched(in_shared_years(fresh, base, year), base, keys)


def merge(base: DataFrame, fresh: DataFrame, keys: list[str], measures: list[str], *,
          year: str = "Year", include_new: bool = False) -> DataFrame:
    """Refreshed base rows, rows of new years, and on request new rows of known years.

    With ``include_new`` both kinds of new rows are simply the fresh rows without
    a base key, because a year absent from the base cannot match. The fresh rows,
    which may be costly to make, are read once: what meets a base row is a
    refreshed one, what does not is new.
    """
    held = base.select(F.lit(True).alias("__hit"), *[F.col(c).alias(f"__b_{c}") for c in base.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    met = fresh.join(held, on, "left")
    hit = F.col("__hit").isNotNull()
    if not include_new:
        known = base.select(year).distinct().withColumn("__known", F.lit(True))
        met = lookup(met, known, [year], "left").where(hit | F.col("__known").isNull())

    def value(c: str) -> Column:
        if c not in fresh.columns:
            return F.col(f"__b_{c}")
        if c not in base.columns:
            return F.when(~hit, F.col(c))
        return F.col(c) if c in measures else F.when(hit, F.col(f"__b_{c}")).otherwise(F.col(c))
    return met.select(*[value(c).alias(c) for c in [*base.columns, *[c for c in fresh.columns if c not in base.columns]]])


def reconcile(base: DataFrame, fresh: DataFrame, keys: list[str], *, year: str = "Year") -> DataFrame:
    """One row: ``n_updated, n_unmatched, n_new_in_shared, n_new_years``.

    Both inputs share one aggregation by key, combined map-side, so a key may
    repeat as often as it likes. ``n_unmatched`` goes negative when duplicate
    keys multiply.
    """
    def marked(df: DataFrame, in_base: int) -> DataFrame:
        return df.select(*keys, F.lit(in_base).cast("bigint").alias("b"), F.lit(1 - in_base).cast("bigint").alias("f"))

    both = marked(base, 1).unionByName(marked(fresh, 0)).groupBy(*keys).agg(
        F.sum("b").alias("n_base"), F.sum("f").alias("n_fresh"))
    by_year = both.groupBy(year).agg(
        F.sum(F.col("n_base") * F.col("n_fresh")).alias("updated"),
        F.sum("n_base").alias("base_rows"), F.sum("n_fresh").alias("fresh_rows"),
        F.sum(F.when(F.col("n_base") == 0, F.col("n_fresh")).otherwise(0)).alias("no_base"))
    shared = (F.col("base_rows") > 0) & (F.col("fresh_rows") > 0)

    def total(value: Column, when: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0)).alias(name)

    out = by_year.agg(
        total(F.col("updated"), shared, "n_updated"),
        total(F.col("base_rows"), shared, "base_in_shared"),
        total(F.col("no_base"), shared, "n_new_in_shared"),
        total(F.col("fresh_rows"), F.col("base_rows") == 0, "n_new_years"))
    return out.select("n_updated", (F.col("base_in_shared") - F.col("n_updated")).alias("n_unmatched"),
                      "n_new_in_shared", "n_new_years")


def _sides(a: DataFrame, b: DataFrame, year: str) -> DataFrame:
    """``(year, __in_a, __in_b)`` of every year; combined before anything moves, for all rows of a year would meet in one task."""
    def marked(df: DataFrame, in_a: bool) -> DataFrame:
        return df.select(year, F.lit(in_a).alias("__in_a"), F.lit(not in_a).alias("__in_b"))
    return marked(a, True).unionByName(marked(b, False)).groupBy(year).agg(F.max("__in_a").alias("__in_a"), F.max("__in_b").alias("__in_b"))


def years_in_both(a: DataFrame, b: DataFrame, year: str = "Year") -> DataFrame:
    return _sides(a, b, year).where("__in_a and __in_b").select(year)


def years_only_in(a: DataFrame, b: DataFrame, year: str = "Year") -> DataFrame:
    return _sides(a, b, year).where("__in_a and not __in_b").select(year)


def last_per_key(df: DataFrame, keys: list[str], load_order: str, *, ties: list[str] = ()) -> DataFrame:
    """The row loaded last for every key."""
    return best_per_key(df, keys, [F.col(load_order).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]])


def _patch_source(source: DataFrame, key: str, columns: list[str], load_order: str) -> DataFrame:
    source = source.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return last_per_key(source.select(key, load_order, *columns), [key], load_order, ties=columns).drop(load_order)


def patch_columns(target: DataFrame, source: DataFrame, key: str, columns: list[str],
                  load_order: str) -> DataFrame:
    """Overwrite the listed columns the target has; later source rows win."""
    columns = [c for c in columns if c in target.columns]
    src = _patch_source(source, key, columns, load_order)
    src = src.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__src_{c}") for c in columns])
    out = lookup(target, src, [key], "left")
    return out.select(*[
        F.when(F.col("__hit"), F.col(f"__src_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns])


def patch_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source does not hold."""
    source = source.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return membership(target, source, [key], present=False)


def patch_report(target: DataFrame, source: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """One row: rows updated, rows not found, and the first three keys not found."""
    missing = patch_missing(target, source, key)
    first = missing.orderBy(*order).limit(3).agg(F.sort_array(F.collect_list(key)).alias("first_missing"))
    total = target.agg(F.count(F.lit(1)).alias("n"))
    gone = missing.agg(F.count(F.lit(1)).alias("n"))
    return first.select((total.scalar() - gone.scalar()).alias("n_updated"),
                        gone.scalar().alias("n_missing"), "first_missing")


def fill_from_lookup(df: DataFrame, found: DataFrame, *, keys: list[str], text: str, found_text: str,
                     year: str, target_year: int, missing: str = "0") -> DataFrame:
    """Fill blank texts of one year from a lookup table.

    Rows with text pass unchanged whatever their year; blank rows of other years
    are dropped. Text keys are compared without the blanks around them. A row with a blank key is kept without a lookup. Found text has
    its newlines collapsed; a failed lookup (NULL text) stays blank and a key the
    table lacks becomes ``missing``.
    """
    has_text = ~S.is_blank(text)
    wanted = df.where(has_text | (F.col(year) == target_year))
    types = dict(df.dtypes)
    bare = {k: S.strip_blanks(k) if types[k] == "string" else F.col(k) for k in keys}
    names = [f"__key{i}" for i in range(len(keys))]
    table = best_per_key(found.select(*[bare[k].alias(n) for k, n in zip(keys, names, strict=True)], F.col(found_text).alias("__found")),
                         names, [F.col("__found").asc_nulls_last()])
    wanted = wanted.withColumns({n: bare[k] for k, n in zip(keys, names, strict=True)})
    out = lookup(wanted, table.withColumn("__hit", F.lit(True)), names, "left")
    usable = ~S.is_blank(keys[0])
    for k in keys[1:]:
        usable = usable & ~S.is_blank(k)
    value = (F.when(has_text, F.col(text))
             .when(~usable, F.lit(""))
             .when(F.col("__hit").isNull(), F.lit(missing))
             .otherwise(F.coalesce(S.collapse_newlines("__found"), F.lit(""))))
    return out.select(*[value.alias(c) if c == text else F.col(c) for c in df.columns])


def overlay(df: DataFrame, progress: DataFrame, key: str, load_order: str) -> DataFrame:
    """Put earlier results over the input, adding the columns they introduced.

    For a key that has results every shared column takes the saved value.
    """
    cols = [c for c in progress.columns if c not in (key, load_order)]
    last = last_per_key(progress, [key], load_order, ties=cols)
    last = last.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__p_{c}") for c in cols])
    out = lookup(df, last, [key], "left")
    kept = [F.when(F.col("__hit"), F.col(f"__p_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in df.columns]
    return out.select(*kept, *[F.col(f"__p_{c}").alias(c) for c in cols if c not in df.columns])


def next_batch(df: DataFrame, done: DataFrame, key: str, n: int = 1500) -> DataFrame:
    """First ``n`` rows, by key, that no earlier batch has finished."""
    return membership(df, done, [key], present=False).orderBy(key).limit(n)


def after_last_success(df: DataFrame, index: str, result: str, *, retry_gaps: bool = False) -> DataFrame:
    """Rows after the last one with a result; with ``retry_gaps`` every row without one."""
    blank = S.is_blank(result)
    if retry_gaps:
        return df.where(blank)
    last = df.agg(F.coalesce(F.max(F.when(~blank, F.col(index))), F.lit(-1).cast("bigint")))
    return df.where(F.col(index) > last.scalar())


def emit_rows(df: DataFrame, text: str, year: str, target_year: int) -> DataFrame:
    """Rows that have text, in any year, and every row of the target year."""
    return df.where(~S.is_blank(text) | (F.col(year) == target_year))
