"""Registered queries (importing this package registers all of them)."""

from tripwire.plans import q_core, q_inject, q_io, q_model, q_props, q_quality  # noqa: F401
from tripwire.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
