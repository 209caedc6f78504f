"""Registered queries over the given tables, each with its SQL counterpart."""

from importlib import import_module

MODULES = ("hot", "text", "quality", "timing", "store", "live", "anomaly")


def load():
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"{__name__}.{module}")
