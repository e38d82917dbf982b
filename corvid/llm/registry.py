"""Queries and SQL of this subpackage, gathered from its modules."""

from __future__ import annotations

import importlib
import pkgutil

import corvid.llm as package


def _modules():
    for info in pkgutil.iter_modules(package.__path__):
        if info.name != "registry":
            yield importlib.import_module(f"{package.__name__}.{info.name}")


def queries() -> dict:
    return {k: v for m in _modules() for k, v in getattr(m, "QUERIES", {}).items()}


def oracles() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in getattr(m, "ORACLES", {}).items()}
