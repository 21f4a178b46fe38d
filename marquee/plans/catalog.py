"""All registered queries and their oracles in one place."""

from __future__ import annotations

from marquee.plans.io_queries import io_oracles, io_queries
from marquee.plans.oracle_sql import plan_oracles
from marquee.plans.queries import Query, plan_queries, with_settings


def all_queries() -> dict[str, Query]:
    qs = {**plan_queries(), **io_queries()}
    return {k: with_settings(v) for k, v in qs.items()}


def all_oracles() -> dict[str, str]:
    return {**plan_oracles(), **io_oracles()}
