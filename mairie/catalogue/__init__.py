"""Registered queries over the generic test tables, each with its SQL counterpart."""

from importlib import import_module

from mairie.catalogue.registry import ORACLES, QUERIES

for _module in ("sources_schema", "scalars_filters", "joins_aggregates", "windows_quality", "reports_models"):
    import_module(f"mairie.catalogue.{_module}")

__all__ = ["ORACLES", "QUERIES"]
