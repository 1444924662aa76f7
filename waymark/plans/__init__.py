"""Registered queries over the driver's tables, each next to its oracle SQL."""

from . import batch, chart, cities, live, model, questions
from .registry import Inputs, oracle_sql, queries

__all__ = ["Inputs", "batch", "chart", "cities", "live", "model", "oracle_sql", "queries", "questions"]
