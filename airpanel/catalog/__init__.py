"""Registered queries, each beside the SQL that must give the same rows."""

from airpanel.catalog import forecasts, graphs, io, panel, scalars, statistics  # noqa: F401
from airpanel.catalog.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
