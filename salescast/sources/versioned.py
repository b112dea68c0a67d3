"""IO4 / FC7: tables that are refreshed year by year, with an atomic switch.

A table is a folder of versions; a version holds the years that its load touched,
and a manifest names, for each year, the version that has it.  A load writes the
new files first and the next manifest last, so readers see the old state or the
new one, and a load that failed leaves files that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.sources.io import exists


class YearTable:
    """Rows by year of ``date_col``; a load replaces whole days."""

    def __init__(self, spark: SparkSession, path: str, date_col: str = "date"):
        self.spark, self.path, self.date_col = spark, path.rstrip("/"), date_col

    def _number(self) -> int:
        """Manifests that are complete; they are numbered from 0."""
        n = 0
        while exists(self.spark, f"{self.path}/manifest-{n}/_SUCCESS"):
            n += 1
        return n

    def years(self) -> dict[int, str]:
        """Folder of each year, by the last complete manifest."""
        n = self._number()
        if not n:
            return {}
        return {int(y): v for y, v in json.loads(self.spark.read.text(f"{self.path}/manifest-{n - 1}").first()[0]).items()}

    def read(self) -> DataFrame | None:
        """All rows, with their ``year``; None before the first load.  A filter
        on ``year`` reads only its folders."""
        return self._of(self.years())

    def _of(self, years: dict[int, str]) -> DataFrame | None:
        if not years:
            return None
        by_version: dict[str, list[int]] = {}
        for y, version in years.items():
            by_version.setdefault(version, []).append(y)
        out = None
        for version, ys in sorted(by_version.items()):
            part = self.spark.read.option("basePath", version).parquet(*[f"{version}/year={y}" for y in sorted(ys)])
            out = part if out is None else out.unionByName(part)
        return out

    def load(self, rows: DataFrame) -> list[int]:
        """Adds ``rows``, in place of all rows of the days they have, and
        returns the years rewritten; years without such days keep their files."""
        day = F.col(self.date_col)
        rows = rows.drop("year").withColumn("year", F.year(day))
        touched = [r["year"] for r in rows.select("year").distinct().collect()]  # years, not rows
        years = self.years()
        old = self._of({y: v for y, v in years.items() if y in touched})
        new = rows
        if old is not None:
            kept = old.join(rows.select(day).distinct(), self.date_col, "left_anti")
            new = kept.select(*rows.columns).unionByName(rows)
        version = f"{self.path}/version-{uuid.uuid4().hex}"
        new.hint("rebalance", "year").sortWithinPartitions("year", self.date_col).write.partitionBy("year").parquet(version)
        self._switch(years | {y: version for y in touched})
        return sorted(touched)

    def _switch(self, years: dict[int, str]) -> None:
        text = json.dumps({str(y): v for y, v in sorted(years.items())})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest-{self._number()}")
