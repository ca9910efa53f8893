"""Registered queries over the given tables."""

from importlib import import_module

from tallyloom.plans.registry import QUERIES, Query

FAMILIES = [
    "panel_queries",
    "linkage_queries",
    "series_queries",
    "choice_queries",
    "statistics_queries",
    "file_queries",
    "scalar_queries",
    "selection_queries",
    "closed_form_queries",
]


def load_all() -> dict[str, Query]:
    for family in FAMILIES:
        import_module(f"tallyloom.plans.{family}")
    return QUERIES
