"""Queries on the benchmark tables, one or more per operator, each with equivalent SQL."""

from . import cleaning, combining, extracts, files, rules, scoping, state
from .base import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "cleaning",
    "combining",
    "extracts",
    "files",
    "rules",
    "scoping",
    "state",
]
