"""The query catalogue: each module registers Spark queries beside their SQL oracles."""

from importlib import import_module

MODULES = ["access", "quality", "joining", "aggregating", "ranking", "business", "lakehouse"]


def load():
    """Import every module of the catalogue and return the registry."""
    for name in MODULES:
        import_module(f"tillwork.plans.{name}")
    return import_module("tillwork.plans.catalog")
