"""The query catalogue; importing it fills the registry."""

from foliograph.plans.catalogue import dates, layout, pages, reports, sqltexts, streams, tables, text  # noqa: F401
from foliograph.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
