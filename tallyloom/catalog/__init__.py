"""Registered queries over the test tables, each with its SQL twin where SQL can say it."""

from tallyloom.catalog import bi, experiments, ingest, metrics, streams, tenants  # noqa: F401
from tallyloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
