"""End-to-end plans and the query registry."""

from importlib import import_module
from types import ModuleType

_MODULES = (
    "text_queries", "line_queries", "assembly_queries", "join_queries", "vote_queries", "diff_queries", "edit_queries", "log_queries", "long_queries", "numbering_queries", "report_queries",
)


def load() -> ModuleType:
    """Import every query module once and return the registry."""
    for name in _MODULES:
        import_module(f"variorum.plans.{name}")
    return import_module("variorum.plans.registry")
