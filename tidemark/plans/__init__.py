"""The registered queries: operators applied to the provided tables, each with the SQL that must
give the same rows."""

from . import aggregates, history, mutation, relational, scalars, scans, scd2, streams, udfs, writes
from .registry import REGISTRY

__all__ = [
    "REGISTRY",
    "aggregates",
    "history",
    "mutation",
    "relational",
    "scalars",
    "scans",
    "scd2",
    "streams",
    "udfs",
    "writes",
]
