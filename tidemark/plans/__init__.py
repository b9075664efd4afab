"""All reports. Importing the modules registers them."""

from tidemark.plans import aggregates, capture, joining, keyed, plumbing, rows, stateful, streams, windowing  # noqa: F401
from tidemark.plans.registry import REPORTS, SQL

__all__ = ["REPORTS", "SQL"]
