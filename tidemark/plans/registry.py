"""Every query of the engine by name, with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "gamma_exposure"


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


# Modules that register their queries when they are imported.
from tidemark.plans import events, gold_chain, gold_gamma, indicators, ingest, positioning, rates, reports, sessions, star, strategies, validation, checks, models  # noqa: E402,F401
