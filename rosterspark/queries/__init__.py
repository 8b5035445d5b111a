"""Queries over the driver's tables, each with DuckDB SQL for the same rows where SQL can express it."""

from . import checks, courses, facets, jobs, lines, maintenance, matching, pages, people, roundtrips, values, works
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "courses", "facets", "jobs", "lines", "maintenance", "matching", "pages", "people", "roundtrips", "values", "works"]
