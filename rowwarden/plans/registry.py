"""Registry of the queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CONFIG = Path(__file__).resolve().parent.parent / "config"


def query(oracle: str | None = None, inputs: tuple[str, ...] = (), name: str | None = None):
    """Register `fn(spark, folder)`; `oracle` is its SQL over the CTEs named in `inputs`."""

    def add(fn):
        key = name or fn.__name__

        QUERIES[key] = fn
        if oracle:
            from rowwarden.plans.inputs import with_inputs

            ORACLES[key] = with_inputs(oracle, inputs)
        return fn

    return add
