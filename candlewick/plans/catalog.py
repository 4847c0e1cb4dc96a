"""All registered queries: importing this module fills the registry."""

from candlewick.plans import q_analytics, q_clean, q_minute, q_more  # noqa: F401
from candlewick.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
