"""The registered queries and their SQL counterparts."""

from tallyloom.plans import (  # noqa: F401  importing a module registers its queries
    cleaning,
    combining,
    counting,
    images,
    ingest,
    learning,
    matrices,
    models,
    ordering,
    streams,
    texts,
)
from tallyloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
