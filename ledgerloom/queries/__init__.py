"""Named queries over the test tables, each with the SQL that states its result."""

from ledgerloom.queries import files, model, reference_tables, reports, returns_targets, sales, scalars  # noqa: F401
from ledgerloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
