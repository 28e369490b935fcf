"""All registered queries."""

from checks import q_buys, q_monthly, q_prices, q_quality, q_reference, q_tax  # noqa: F401
from checks.registry import QUERIES

__all__ = ["QUERIES"]
