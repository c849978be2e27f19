"""The catalogue's jobs end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import clean, density, evolution, merge, rank, stats, text
from ..operators.select import Selection
from ..sources import pages


def clean_catalogue(raw: DataFrame, *, required: list[str] = vocab.REQUIRED_COLUMNS,
                    keys: list[str] = ("Artist", "Title"), measure: str = "Streams", year: str = "Year",
                    n: int = 300, ties: list[str]) -> DataFrame:
    """Complete rows, the best per key, the top ``n`` per year.

    Exact copies share their key, so keep-best removes them too and no shuffle
    of whole rows is spent on them. What remains is one shuffle by key and one by
    year, each after losers were dropped map-side.
    """
    return _stages(raw, required, list(keys), measure, year, n, list(ties))[-1][1]


def clean_funnel(raw: DataFrame, *, required: list[str] = vocab.REQUIRED_COLUMNS,
                 keys: list[str] = ("Artist", "Title"), measure: str = "Streams", year: str = "Year",
                 n: int = 300, ties: list[str]) -> DataFrame:
    """Rows removed by each step of the cleaning job, copies counted separately."""
    _, _, (best, kept), top = _stages(raw, required, list(keys), measure, year, n, list(ties))
    loading = clean.loading_counts(raw, clean.available(raw, required))
    return clean.funnel([(["loaded", "missing", "copies"], loading), (best, clean.counted(kept, year)), top])


def _stages(raw, required, keys, measure, year, n, ties) -> list[tuple[str, DataFrame]]:
    complete = clean.drop_missing(raw, clean.available(raw, required))
    numeric = complete
    if dict(raw.dtypes)[measure] == "string":
        numeric = clean.coerce_measure(complete, measure)
    best = clean.keep_best(numeric, keys, measure, [F.col(t).asc_nulls_last() for t in ties])
    top = clean.top_per_year(clean.drop_columns(best), n, year=year, measure=measure, ties=ties)
    return [("loaded", raw), ("missing", complete), ("repeated keys", best), ("top rows", top)]


def refresh_catalogue(base: DataFrame, stored_pages: DataFrame, *, html: str = "html", page_year: str = "year",
                      include_new: bool = False) -> tuple[DataFrame, DataFrame]:
    """Catalogue refreshed from stored chart pages, and its reconciliation report."""
    fresh = pages.chart_rows(stored_pages, html=html, year=page_year)
    keys, measures = ["Artist and Title", "Year"], ["Streams", "Daily"]
    return (merge.merge(base, fresh, keys, measures, include_new=include_new), merge.reconcile(base, fresh, keys))


@dataclass
class Dashboard:
    """The chart tables of one selection; each is a lazy DataFrame."""

    tracks: DataFrame
    words: DataFrame
    features: list[str]
    selection: Selection = Selection()
    tie: str = "track_id"

    def selected(self) -> DataFrame:
        return self.selection.tracks(self.tracks)

    def charts(self) -> dict[str, DataFrame]:
        chosen = self.selected()
        bounds = stats.feature_stats(self.tracks, chosen, self.features)
        words = self.selection.words(self.words)
        return {
            "artists": rank.top_total(chosen, 10),
            "stats": bounds,
            "trend": stats.yearly_means(self.tracks, self.features),
            "density": density.density(chosen, self.features, h=0.12, bounds=bounds),
            "ridgeline": density.density_with_total(self.tracks, self.features, group="Year", bounds=bounds),
            "key_ring": evolution.key_ring(chosen),
            "parallel": rank.every_nth(chosen, [self.tie]),
            "topic_share": evolution.share_by_year(self.tracks),
            "word_cloud": text.word_cloud(text.all_time_words(words)),
            "word_categories": evolution.category_totals(words),
            "word_evolution": evolution.category_by_year(self.words),
        }
