"""Registered queries. Importing this package fills the registry."""

from importlib import import_module

from cliploom.plans.registry import CATALOGUE, Entry, Tables

MODULES = ("queue", "integrity", "provenance", "storage", "catalog", "series", "media", "names", "gates", "streams")

for _name in MODULES:
    import_module(f"cliploom.plans.{_name}")

__all__ = ["CATALOGUE", "Entry", "Tables"]
