"""Every operator as a query over the standard tables, with the SQL it must equal."""

from . import aggregates, anomalies, cleaning, features, models, runs, windows  # noqa: F401
from .base import OPERATORS, ORACLES, QUERIES

__all__ = ["OPERATORS", "ORACLES", "QUERIES"]
