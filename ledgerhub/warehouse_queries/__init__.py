"""Every operator at work on the given tables, each with the SQL that must give the same rows."""

from ledgerhub.warehouse_queries import (  # noqa: F401
    alerting, healing, histories, landing, loading, matching, reconciling, streams,
)
from ledgerhub.warehouse_queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
