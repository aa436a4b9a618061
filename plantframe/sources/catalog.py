"""Named resource tables and the scans over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import PlantError
from ..operators.datapoints import check_series_kind, datapoints
from ..operators.hierarchy import subtree, with_aggregates
from ..operators.predicates import parse_ids
from .schemas import READ_SCHEMAS


class Catalog:
    """Resource name to table. A table is a function, so nothing is read before it is asked for."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._tables = dict(tables)

    @classmethod
    def from_directory(cls, spark: SparkSession, root: str, resources: Sequence[str] | None = None) -> Catalog:
        """Tables stored as ``root/<resource>`` in parquet with the declared columns."""

        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(READ_SCHEMAS[name]).parquet(f"{root}/{name}")

        return cls(spark, {name: reader(name) for name in resources or READ_SCHEMAS})

    def resources(self) -> list[str]:
        return sorted(self._tables)

    def table(self, resource: str) -> DataFrame:
        if resource not in self._tables:
            raise PlantError(f"Unknown resource type {resource}, known are {', '.join(self.resources())}")
        return self._tables[resource]()

    def scan(
        self,
        resource: str,
        *,
        where: Column | str | None = None,
        columns: Sequence[str] | None = None,
        asset_subtree_ids: str | None = None,
        model_id: int | None = None,
        revision_id: int | None = None,
        aggregates: bool = False,
    ) -> DataFrame:
        """A resource as a table; the optimizer pushes the filter and the columns into the files.

        ``aggregates`` fills that column of assets, which takes about log2(depth) joins over the whole tree.
        """
        df = self.table(resource)
        if aggregates:
            df = with_aggregates(df)
        if asset_subtree_ids is not None:
            df = subtree(df, *parse_ids(asset_subtree_ids))
        if model_id is not None:
            df = df.filter(F.col("modelId" if "modelId" in df.columns else "id") == model_id)
        if revision_id is not None:
            df = df.filter(F.col("revisionId") == revision_id)
        if where is not None:
            df = df.filter(where)
        return df.select(*columns) if columns else df

    def points(
        self,
        resource: str = "datapoints",
        *,
        ids: Sequence[int] = (),
        external_ids: Sequence[str] = (),
        start: datetime | str | None = None,
        end: datetime | str | None = None,
        closed: str = "left",
    ) -> DataFrame:
        """Points of named series of one kind. Without a name, and for series of the other kind, it is an error; unknown
        names have no points."""
        found = datapoints(self.table(resource), ids=ids, external_ids=external_ids, start=start, end=end, closed=closed)
        series = self.table("timeseries")
        asked = series.filter(F.col("id").isin(list(ids)) | F.col("externalId").isin(list(external_ids)))
        wrong = check_series_kind(asked, asked, is_string=resource == "stringdatapoints").select("error").orderBy("error").limit(10)
        messages = [r["error"] for r in wrong.collect()]
        if messages:
            raise PlantError("; ".join(messages))
        return found

    def register_views(self, prefix: str = "") -> None:
        """Make every resource available to ``spark.sql`` under its name."""
        for name in self._tables:
            self.table(name).createOrReplaceTempView(prefix + name)
