"""Queries over the given tables, one module per operator family."""

import importlib

MODULES = ["reporting", "scalars", "crawl", "tables", "decisions", "discovery", "landing"]


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"sightline.bindings.{name}")
