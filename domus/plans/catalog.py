"""Imports every catalog module so their queries register."""

from __future__ import annotations

import importlib

MODULES = [
    "domus.plans.catalog_prep",
    "domus.plans.catalog_features",
    "domus.plans.catalog_eval",
    "domus.plans.catalog_edges",
    "domus.plans.catalog_models",
]


def load() -> None:
    for m in MODULES:
        importlib.import_module(m)
