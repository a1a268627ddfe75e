"""All queries of the library and their SQL, by name."""

from . import assets, expression, layout, relational, scans, spatial, statistics, validation, views  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
