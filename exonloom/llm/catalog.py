"""Imports the modules that register the queries of this subpackage."""

from . import queries  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
