"""Every operator as a runnable query over the test tables, with an equivalent SQL text."""

from tidegrid.workload.registry import all_queries, all_sql


def load():
    """Import all query modules and return (queries, sql)."""
    from tidegrid.workload import (  # noqa: F401
        cells, geometry, listings, planning, reports, state, streams, temporal,
    )

    return all_queries(), all_sql()
