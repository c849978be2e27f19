"""Imports every module of this subpackage that registers a query."""

from . import (  # noqa: F401
    brown, decontaminate, edit_counts, licences, mixing, near_dedup, packing, periodic_runs, quality_model, quality_rules, resident_codebooks,
    url_filter, warc)
from .registry import ORACLES, QUERIES  # noqa: F401
