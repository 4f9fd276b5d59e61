"""What a night publishes: one log file that names the directories of every mart.

Marts are written to directories of their own first, so a reader sees all marts of one night or all of the
night before, and a night that fails before it publishes has changed nothing for readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillbook.sources.snapshots import SnapshotTable


class Nights:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, SnapshotTable(spark, path)

    def publish(self, marts: dict[str, list[str]], batch: str | None = None) -> None:
        """Make these directories the marts that readers see; a mart that is not named is gone."""
        now = self.log.state()
        rows = {f"{name}/{i}": place for name, places in marts.items() for i, place in enumerate(places)}
        gone = dict.fromkeys(set(now.directories) - set(rows))
        self.log.point(now, rows | gone, batch)

    def published(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for name, place in sorted(self.log.directories().items()):
            out.setdefault(name.rsplit("/", 1)[0], []).append(place)
        return out

    def read(self, mart: str) -> DataFrame:
        places = self.published().get(mart)
        if not places:
            raise FileNotFoundError(f"no night has published {mart}")
        return self.spark.read.parquet(*places)
