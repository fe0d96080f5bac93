"""Registered queries: each operator on the test tables, with the SQL its result is checked against."""

from importlib import import_module

MODULES = ("basics", "provider", "tracking", "funnel", "quality", "integrity", "quiz", "matrix", "files", "delivery", "merging", "exports")


def load_all() -> None:
    import_module("suite.roles")
    for name in MODULES:
        import_module(f"suite.{name}")
