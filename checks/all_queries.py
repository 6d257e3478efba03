"""Imports every query module, which fills the registry."""

import importlib
import pkgutil

import checks
import checks.views  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401

for module in sorted(m.name for m in pkgutil.iter_modules(checks.__path__)):
    if module.endswith("_queries") and module != "all_queries":
        importlib.import_module(f"checks.{module}")
