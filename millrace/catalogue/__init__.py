"""All registered queries."""

from millrace.catalogue import entitlement, entitlement_log, feed, ingest, log, scalars, windows  # noqa: F401
from millrace.catalogue.registry import ENTRIES

__all__ = ["ENTRIES"]
