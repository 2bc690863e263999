"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations


def load():
    """The registry, with all query modules imported."""
    from workload import (  # noqa: F401
        classification, columns, ingestion, reconciliation, registry, state, streams,
        submission, warehouse,
    )

    return registry
