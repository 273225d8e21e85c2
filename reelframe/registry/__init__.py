from reelframe.registry import load, ml, rows, serve
from reelframe.registry.base import ORACLES, QUERIES, table

__all__ = ["ORACLES", "QUERIES", "load", "ml", "rows", "serve", "table"]
