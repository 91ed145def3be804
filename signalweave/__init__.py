"""Text-signal analytics on PySpark: tag posts, apply rules, build monthly series."""

from signalweave.session import build_session

__all__ = ["build_session"]
