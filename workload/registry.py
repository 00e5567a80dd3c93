"""Named queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def load_all() -> None:
    from workload import cohort_queries, event_queries, incidence_queries, population_queries  # noqa: F401
