"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from lakegate.plans import governance, intake, publication, streams, texts  # noqa: F401
from lakegate.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
