"""Imports every module that registers queries."""

from . import catalogue_queries, evolution_queries, feature_queries, job_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
