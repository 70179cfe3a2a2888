"""Named queries over the test tables (with DuckDB oracle SQL)."""

from kestrel.plans.registry import HEADLINE, REGISTRY
from kestrel.plans import scalar, profiling, features, series, text, sequences, models  # noqa: F401  (registers queries)

__all__ = ["REGISTRY", "HEADLINE"]
