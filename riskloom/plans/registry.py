"""Name -> query callable ``(spark, sf_dir) -> DataFrame``.

Every registered query derives the domain tables from the full driver tables
in ``sf_dir`` (no row caps, no id subsets); limits appear only where the
report itself is a top-k.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.tables import Domain, load_domain

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, QueryFn] = {}
_DOMAIN_FNS: dict[str, Callable[[Domain], DataFrame]] = {}


def register(name: str):
    """Register ``fn(domain) -> DataFrame`` under ``name``; the query loads the
    domain tables of ``sf_dir`` and applies ``fn``."""

    def deco(fn: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(load_domain(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        _DOMAIN_FNS[name] = fn
        return fn

    return deco


def register_raw(name: str):
    """Register ``fn(spark, sf_dir) -> DataFrame`` as it is."""

    def deco(fn: QueryFn):
        _REGISTRY[name] = fn
        return fn

    return deco


def all_queries() -> dict[str, QueryFn]:
    # import for the registration side effect
    from riskloom.plans import catalog  # noqa: F401

    return dict(_REGISTRY)


def domain_queries() -> dict[str, Callable[[Domain], DataFrame]]:
    """The same reports as functions of already-loaded domain tables."""
    all_queries()
    return dict(_DOMAIN_FNS)
