"""End-to-end jobs and the catalog of bindings on the driver tables."""

from chunkwise.plans import kept as _kept  # noqa: F401  (registers stored-table keys)
from chunkwise.plans import learned as _learned  # noqa: F401  (registers model/stream keys)
from chunkwise.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
