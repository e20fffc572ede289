"""Every operator as a registered query; importing the modules registers them."""

from netrill.catalog import outputs, records, streams, totals  # noqa: F401
from netrill.catalog.registry import QUERIES, STATEMENTS

__all__ = ["QUERIES", "STATEMENTS"]
