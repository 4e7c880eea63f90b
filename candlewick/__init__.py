"""Distributed market-data analytics on PySpark: bars, ticks, news, features."""

from candlewick.session import build_session, shared_dir
from candlewick.series import Series

__all__ = ["Series", "build_session", "shared_dir"]
