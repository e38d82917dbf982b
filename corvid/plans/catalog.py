"""Registered queries of the library with the SQL that each is held against."""

from __future__ import annotations

import importlib
import pkgutil

from corvid import plans

FLAGSHIP = "band_join_line_coverage"


def _modules():
    for info in pkgutil.iter_modules(plans.__path__):
        if info.name != "catalog":
            yield importlib.import_module(f"{plans.__name__}.{info.name}")


def queries() -> dict:
    return {k: v for m in _modules() for k, v in getattr(m, "QUERIES", {}).items()}


def oracles() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in getattr(m, "ORACLES", {}).items()}
