"""Imports every operator module, which fills the registry."""

import importlib
import pkgutil

import fieldstar.llm
from fieldstar.llm.common import ORACLES, QUERIES  # noqa: F401

for module in sorted(m.name for m in pkgutil.iter_modules(fieldstar.llm.__path__)):
    if module != "queries":
        importlib.import_module(f"fieldstar.llm.{module}")
