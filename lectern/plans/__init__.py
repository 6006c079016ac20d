"""Queries: operators bound to the driver's tables."""

from __future__ import annotations

import importlib
import pkgutil


def load_all() -> None:
    """Import every module of this package, which registers its queries."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
