"""Every operator bound to the test tables, with its oracle statement."""

from __future__ import annotations

import importlib

from heronlake.catalog.registry import QUERIES

SECTIONS = (
    "io", "scalar", "joins", "aggregates", "windows", "topk", "reshape", "spines", "islands",
    "cohorts", "cleaning", "quality", "logs", "graph", "trees", "series", "sequences", "text", "streams",
)

for _section in SECTIONS:
    importlib.import_module(f"heronlake.catalog.{_section}")

__all__ = ["QUERIES"]
