"""Named sources (S11): logical names resolved to DataFrame loaders, plus SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Loader = Callable[[SparkSession], DataFrame]


class Sources:
    """A registry of ``name -> loader``; ``get`` resolves lazily, ``register_views`` exposes them to SQL."""

    def __init__(self, loaders: dict[str, Loader] | None = None):
        self._loaders: dict[str, Loader] = dict(loaders or {})

    def add(self, name: str, loader: Loader) -> Sources:
        self._loaders[name] = loader
        return self

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def get(self, spark: SparkSession, name: str) -> DataFrame:
        try:
            return self._loaders[name](spark)
        except KeyError:
            raise KeyError(f"unknown source {name!r}; known: {self.names()}") from None

    def register_views(self, spark: SparkSession) -> None:
        for name in self._loaders:
            self.get(spark, name).createOrReplaceTempView(name)


def testbed_sources(sf_dir: str) -> Sources:
    """The driver tables seen as the pipeline's named sources."""
    from ridemart.sources import testbed
    return Sources({
        "green_tripdata_ext": lambda s: testbed.green(s, sf_dir),
        "yellow_tripdata_ext": lambda s: testbed.yellow(s, sf_dir),
        "taxi_zone_lookup": lambda s: testbed.zone_seed(s, sf_dir),
    })
