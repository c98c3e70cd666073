"""Event-time quality engine for keyed sensor readings, on PySpark."""

from wakeline.settings import Rules

__all__ = ["Rules"]
