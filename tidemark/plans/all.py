"""Import every query module so that the registry is complete."""

from tidemark.plans import audit, basics, cdc, changes, quality, sources  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
