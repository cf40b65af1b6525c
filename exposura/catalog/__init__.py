"""Registered queries: importing the modules fills the registry."""

from exposura.catalog.base import ORACLES, QUERIES


def _load() -> None:
    from exposura.catalog import (  # noqa: F401
        q_aggregates,
        q_filters,
        q_inference,
        q_joins,
        q_matching,
        q_pages,
        q_projections,
        q_scalars,
        q_sensitive,
        q_sinks,
        q_sources,
        q_streaming,
        q_windows,
    )


def queries():
    _load()
    return dict(QUERIES)


def oracles():
    _load()
    return dict(ORACLES)
