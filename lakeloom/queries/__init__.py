"""Queries registered with the driver and their SQL checks."""

from lakeloom.queries import bronze, bronze_activity, curated, ingest, jobs, matching, storage, type_errors
from lakeloom.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "bronze", "bronze_activity", "curated", "ingest", "jobs", "matching", "storage", "type_errors"]
