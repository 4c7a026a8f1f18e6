"""The registered queries over the test tables, and their SQL checks."""

from importlib import import_module

AREAS = ["daily", "holders", "majors", "monthly", "brokers", "parsing", "files", "general", "jobs"]


def load() -> None:
    """Import every area, which registers its queries."""
    for area in AREAS:
        import_module(f"bourseline.workload.{area}")
