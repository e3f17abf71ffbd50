"""Named queries over the test tables, each with its SQL check where SQL can say it."""

from importlib import import_module

MODULES = ["cleaning", "profiling", "reports", "features", "recommend", "sources"]


def load():
    """Import every query module and return the registry they filled."""
    for name in MODULES:
        import_module(f"basketlens.plans.{name}")
    return import_module("basketlens.plans.registry")
