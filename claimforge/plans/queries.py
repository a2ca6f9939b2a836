"""All queries of the library, without those of the optional subpackage."""

from __future__ import annotations

from claimforge.plans import changes, flows, relations, scalars  # noqa: F401  they register themselves
from claimforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
