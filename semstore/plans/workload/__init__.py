"""The registered queries: each runs one operator over whole tables, next to SQL that gives the same rows."""

from semstore.plans.workload import filtering, recordkeeping, similarity, texts
from semstore.plans.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "filtering", "recordkeeping", "similarity", "texts"]
