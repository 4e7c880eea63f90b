"""Import every query module, so that the registry is complete."""

from candlewick.plans.catalogue.registry import REGISTRY
from candlewick.plans.catalogue import candles, flows, news, series, tables, training  # noqa: F401

__all__ = ["REGISTRY"]
