"""Queries over the TPC-H-like test tables: views in the library's schemas, and a registry."""

import importlib

# Order of registration, and so of the registry.
MODULES = ["betting", "cleaning", "reports", "relational", "storage", "study"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"workload.{name}")
