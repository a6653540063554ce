"""Imports every module that registers queries."""

from . import q_annotations, q_compare, q_hits, q_intervals, q_models, q_readers, q_sequence  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
