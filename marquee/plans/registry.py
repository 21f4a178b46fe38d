"""Dataset registry: source kind, landing feed, tables, cleaner and mart per dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from marquee.operators.cleaners import CLEANERS
from marquee.operators.marts import MARTS
from marquee.sources.readers import FEEDS


@dataclass(frozen=True)
class Dataset:
    name: str
    source: str                      # api | file | db
    feed: str                        # landing file / folder name
    bronze_table: str
    silver_table: str
    gold_table: str
    cleaner: Callable[[DataFrame], DataFrame]
    mart: Callable[[DataFrame], DataFrame]
    per_title: bool                  # gold keyed by movie_key


_SOURCES = {"movies": "api", "scores": "file", "watchlist": "file", "awards": "file",
            "users": "db", "ratings": "db", "reviews": "db"}

DATASETS: dict[str, Dataset] = {
    ds: Dataset(name=ds, source=_SOURCES[ds], feed=FEEDS[ds][0], bronze_table=ds,
                silver_table=ds, gold_table=MARTS[ds][0], cleaner=CLEANERS[ds],
                mart=MARTS[ds][1], per_title=ds not in ("movies", "users"))
    for ds in _SOURCES
}


def dataset(name: str) -> Dataset:
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(f"unknown dataset {name!r}") from None
