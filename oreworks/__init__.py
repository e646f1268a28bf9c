"""Rules-driven refinement of monthly raw tables, as plain Spark DataFrame code."""

from oreworks.model import Combination, Settings, SourceSpec

__all__ = ["Combination", "Settings", "SourceSpec"]
