"""Registered queries on the driver tables."""

MODULES = ("channels", "sources", "derivations", "relational", "reconciliation", "expenses")


def load_all() -> None:
    from importlib import import_module

    for name in MODULES:
        import_module(f"workload.{name}")
