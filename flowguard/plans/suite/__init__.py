"""Every operator as a query over the driver tables, most with the SQL it must agree with."""

from importlib import import_module

SUITES = ["wire", "cleaning", "scalars", "windows", "edges", "joins", "metrics", "models", "learned", "jobs", "streams"]


def load_suite():
    from flowguard.plans.suite import base

    for name in SUITES:
        import_module(f"flowguard.plans.suite.{name}")
    return base.QUERIES, base.ORACLES
