"""Query suites over the test tables."""

from importlib import import_module

_SUITES = ("scd2", "append", "columns", "ledger", "checks", "series", "sources", "streams")


def load():
    """Import every suite and return the filled registry."""
    for name in _SUITES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
