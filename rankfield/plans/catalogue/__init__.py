"""Every query this library answers, each with its check in SQL."""

from rankfield.plans.catalogue import loading, profiling, relational, retrieval
from rankfield.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "loading", "profiling", "relational", "retrieval"]
