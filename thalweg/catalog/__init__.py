"""The registered queries, one module per family of operators."""

from importlib import import_module

from thalweg.catalog.registry import ORACLES, QUERIES

MODULES = ("series", "risk", "features", "quality", "state", "sources", "misc", "evaluation", "jobs")

for _module in MODULES:
    import_module(f"thalweg.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
