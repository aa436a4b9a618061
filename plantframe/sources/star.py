"""The benchmark tables seen as resources: assets, events, time series, sequences, instances and so on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import Connection, DataModel, Graph, Property, View, ViewRef
from .catalog import Catalog
from .schemas import read_schema

# Columns of the benchmark tables. Their times have no zone and are read as UTC.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}

STRING_SERIES = 10_000_000
FIRST_CUSTOMER = 1_000_000
FIRST_NATION = 1000
PART_VIEW = View(
    "models", "Part", "1", "node",
    (Property("name", "text"), Property("brand", "text"), Property("size", "int32"), Property("price", "float64")),
    (Connection("suppliedBy", "types", "flag-A"),),
)
# The same table under other names and types, and another connection of the same name.
PART_VIEW_2 = View(
    "models", "Part", "2", "node",
    (Property("title", "text", stored="name"), Property("size", "int64"), Property("cost", "int32", stored="price")),
    (Connection("suppliedBy", "types", "flag-R"),),
)
SUPPLIER_VIEW = View(
    "models", "Supplier", "1", "node",
    (Property("name", "text"), Property("balance", "float64"), Property("favourite", "direct")),
)
SUPPLY_VIEW = View(
    "models", "Supply", "1", "edge", (Property("quantity", "float64"), Property("discount", "float64"))
)


def text(*parts: str | Column) -> Column:
    """Concatenate literals and columns (given as Column) to text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def line_key(separator: str) -> Column:
    """A key of an order line; line numbers repeat within an order, so the key names more than those."""
    return F.concat_ws(
        separator, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"),
        F.unix_date(F.to_date("l_shipdate")),
    )


def ref(space: str, external_id: Column) -> Column:
    return F.struct(F.lit(space).alias("space"), external_id.alias("externalId"))


class Star:
    """Benchmark tables of one folder, and the resources made from them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.catalog = Catalog(
            spark,
            {
                "assets": self.assets,
                "events": self.events,
                "timeseries": self.timeseries,
                "datapoints": self.datapoints,
                "stringdatapoints": self.stringdatapoints,
                "files": self.files,
                "sequences": self.sequences,
                "sequencerows": self.sequencerows,
                "labels": self.labels,
                "relationships": self.relationships,
                "datasets": self.datasets,
                "raw": self.raw,
                "3dmodels": self.models3d,
                "3dmodelrevisions": self.revisions3d,
                "3dmodelrevisionnodes": self.nodes3d,
                "3dmodelrevisionmappings": self.mappings3d,
            },
        )

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{name}.parquet")

    def _shaped(self, resource: str, df: DataFrame, **columns: Column) -> DataFrame:
        """Columns of the resource in their order and type; those not given are null."""
        return df.select(
            *[
                columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in read_schema(resource).fields
            ]
        )

    def assets(self) -> DataFrame:
        made = F.lit("2020-01-01 00:00:00").cast("timestamp")
        times = {"createdTime": made, "lastUpdatedTime": made}
        region, nation = self.base("region"), self.base("nation")
        customer = self.base("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        tops = self._shaped(
            "assets", region, externalId=text("region-", F.col("r_regionkey")), name=F.col("r_name"),
            source=F.lit("region"), id=F.col("r_regionkey") + 1, rootId=F.col("r_regionkey") + 1, **times,
        )
        middles = self._shaped(
            "assets", nation, externalId=text("nation-", F.col("n_nationkey")), name=F.col("n_name"),
            parentId=F.col("n_regionkey") + 1, parentExternalId=text("region-", F.col("n_regionkey")),
            source=F.lit("nation"), id=F.col("n_nationkey") + FIRST_NATION, rootId=F.col("n_regionkey") + 1,
            dataSetId=F.col("n_nationkey"), **times,
        )
        leaves = self._shaped(
            "assets", customer, externalId=text("customer-", F.col("c_custkey")), name=F.col("c_name"),
            parentId=F.col("c_nationkey") + FIRST_NATION, parentExternalId=text("nation-", F.col("c_nationkey")),
            description=F.col("c_mktsegment"), metadata=F.create_map(F.lit("segment"), F.col("c_mktsegment")),
            source=F.lit("customer"), id=F.col("c_custkey") + FIRST_CUSTOMER, rootId=F.col("n_regionkey") + 1,
            dataSetId=F.col("c_nationkey"), labels=F.array("c_mktsegment"), **times,
        )
        return tops.unionByName(middles).unionByName(leaves)

    def events(self) -> DataFrame:
        start = F.col("o_orderdate")
        return self._shaped(
            "events", self.base("orders"), id=F.col("o_orderkey"), startTime=start,
            endTime=F.when(F.col("o_orderstatus") != "O", start + F.expr("interval 7 days")),
            type=F.col("o_orderpriority"), subtype=F.nullif(F.col("o_orderstatus"), F.lit("P")),
            metadata=F.create_map(F.lit("priority"), F.col("o_orderpriority"), F.lit("status"), F.col("o_orderstatus")),
            assetIds=F.array(F.col("o_custkey") + FIRST_CUSTOMER), source=F.lit("orders"),
            externalId=text("order-", F.col("o_orderkey")), createdTime=start, lastUpdatedTime=start,
        )

    def datapoints(self) -> DataFrame:
        return self.base("events").select(
            F.col("user_id").alias("id"), text("user-", F.col("user_id")).alias("externalId"),
            F.col("ts").alias("timestamp"), "value",
        )

    def stringdatapoints(self) -> DataFrame:
        return self.base("events").select(
            (F.col("user_id") + STRING_SERIES).alias("id"), text("text-", F.col("user_id")).alias("externalId"),
            F.col("ts").alias("timestamp"), F.col("event_type").alias("value"),
        )

    def timeseries(self) -> DataFrame:
        users = self.base("events").select("user_id").distinct()
        unit = F.element_at(F.array(F.lit("bar"), F.lit("degC"), F.lit("m3")), (F.col("user_id") % 3 + 1).cast("int"))
        kinds = F.explode(F.array(F.lit(False), F.lit(True))).alias("isString")
        both = users.select("user_id", kinds)
        name = text(F.when(F.col("isString"), "text-").otherwise("user-"), F.col("user_id"))
        return self._shaped(
            "timeseries", both, name=name, isString=F.col("isString"), unit=F.when(~F.col("isString"), unit),
            assetId=F.col("user_id") + FIRST_CUSTOMER, isStep=F.col("user_id") % 2 == 0,
            id=F.col("user_id") + F.when(F.col("isString"), STRING_SERIES).otherwise(0), externalId=name,
        )

    def files(self) -> DataFrame:
        return self._shaped(
            "files", self.base("documents"), id=F.col("doc_id"), name=text("doc-", F.col("doc_id"), ".txt"),
            source=F.col("source"), directory=text("/", F.col("lang")), externalId=text("doc-", F.col("doc_id")),
            mimeType=F.lit("text/plain"), uploaded=F.lit(True), labels=F.array("lang"),
        )

    def sequences(self) -> DataFrame:
        users = self.base("events").select("user_id").distinct()
        columns = F.array(
            *[
                F.struct(
                    F.lit(n).alias("externalId"), F.lit(n).alias("name"),
                    F.lit(None).cast("string").alias("description"), F.lit(t).alias("valueType"),
                )
                for n, t in (("value", "DOUBLE"), ("kind", "STRING"), ("k", "LONG"))
            ]
        )
        return self._shaped(
            "sequences", users, id=F.col("user_id"), name=text("sequence ", F.col("user_id")),
            externalId=text("seq-", F.col("user_id")), columns=columns,
        )

    def sequencerows(self) -> DataFrame:
        return self.base("events").select(
            F.col("user_id").alias("id"), text("seq-", F.col("user_id")).alias("externalId"),
            F.col("event_id").alias("rowNumber"), "value", F.col("event_type").alias("kind"),
            F.get_json_object("props", "$.k").cast("long").alias("k"),
        )

    def labels(self) -> DataFrame:
        brands = self.base("part").select("p_brand").distinct()
        return self._shaped("labels", brands, externalId=F.col("p_brand"), name=F.lower("p_brand"))

    def relationships(self) -> DataFrame:
        return self._shaped(
            "relationships", self.base("lineitem"),
            externalId=text(F.col("l_orderkey"), ":", F.col("l_linenumber")),
            sourceExternalId=text("part-", F.col("l_partkey")), sourceType=F.lit("asset"),
            targetExternalId=text("supplier-", F.col("l_suppkey")), targetType=F.lit("asset"),
            startTime=F.col("l_shipdate"), confidence=F.col("l_discount") * 10, labels=F.array("l_returnflag"),
        )

    def datasets(self) -> DataFrame:
        return self._shaped(
            "datasets", self.base("nation"), id=F.col("n_nationkey"), name=F.col("n_name"),
            writeProtected=F.col("n_regionkey") == 0, externalId=text("nation-", F.col("n_nationkey")),
        )

    def raw(self) -> DataFrame:
        return self.base("events").select(
            F.col("event_id").cast("string").alias("key"), F.col("ts").alias("lastUpdatedTime"),
            F.col("props").alias("columns"),
        )

    def raw_lines(self) -> DataFrame:
        """A JSON table with numbers, text, nested values, reserved names and conflicting types."""
        cents = F.round(F.col("l_extendedprice") * 100).cast("long")
        returned = F.col("l_returnflag") == "R"
        words = text(F.col("l_returnflag"), F.col("l_linestatus"))
        columns = text(
            '{"num":', F.col("l_linenumber"), ',"numText":"', F.col("l_linenumber"), '","empty":"","flag":',
            F.when(returned, "true").otherwise("false"), ',"flagText":"', F.when(returned, "TRUE").otherwise("no"),
            '","cents":', cents, ',"note":', F.when(returned, '"back"').otherwise("null"), ',"nested":{"part":',
            F.col("l_partkey"), ',"tags":["', F.col("l_returnflag"), '","', F.col("l_linestatus"),
            '"]},"mixed":', F.when(returned, '"n/a"').otherwise(F.col("l_suppkey").cast("string")), ',"amount":"',
            F.floor(cents / 100), ".", F.lpad((cents % 100).cast("string"), 2, "0"), '","bin":"',
            F.base64(F.encode(words, "utf-8")), '","key":"inner-', F.col("l_linenumber"), '","_key":"deep-',
            F.col("l_suppkey"), '","lastUpdatedTime":"never"}',
        )
        return self.base("lineitem").select(
            line_key("-").alias("key"), F.col("l_shipdate").alias("lastUpdatedTime"), columns.alias("columns")
        )

    def models3d(self) -> DataFrame:
        return self._shaped("3dmodels", self.base("part"), id=F.col("p_partkey"), name=F.col("p_name"))

    def revisions3d(self) -> DataFrame:
        return self._shaped(
            "3dmodelrevisions", self.base("part"), id=F.col("p_partkey") * 100 + F.col("p_size"),
            modelId=F.col("p_partkey"), status=F.lit("Done"), assetMappingCount=F.col("p_size"),
        )

    def nodes3d(self) -> DataFrame:
        return self._shaped(
            "3dmodelrevisionnodes", self.base("lineitem"), id=F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            modelId=F.col("l_partkey"), revisionId=F.col("l_partkey"), name=F.col("l_linestatus"),
        )

    def mappings3d(self) -> DataFrame:
        return self._shaped(
            "3dmodelrevisionmappings", self.base("lineitem"),
            nodeId=F.col("l_orderkey") * 10 + F.col("l_linenumber"), assetId=F.col("l_suppkey") + FIRST_CUSTOMER,
            modelId=F.col("l_partkey"), revisionId=F.col("l_partkey"),
        )

    def graph(self) -> Graph:
        part, supplier, line = self.base("part"), self.base("supplier"), self.base("lineitem")
        no_ref = F.lit(None).cast("struct<space:string,externalId:string>")
        created = F.lit(1_577_836_800_000).cast("long")

        def instances(df: DataFrame, space: str, key: Column, version: Column, **more: Column) -> DataFrame:
            return df.select(
                F.lit(space).alias("space"), key.alias("externalId"), version.cast("long").alias("version"),
                created.alias("createdTime"), created.alias("lastUpdatedTime"),
                F.lit(None).cast("long").alias("deletedTime"), *[c.alias(n) for n, c in more.items()],
            )

        part_key, supplier_key = text("part-", F.col("p_partkey")), text("supplier-", F.col("s_suppkey"))
        edge_key = line_key(":")
        nodes = instances(
            part, "parts", part_key, F.col("p_size"), _type=ref("types", F.col("p_type"))
        ).unionByName(instances(supplier, "suppliers", supplier_key, F.lit(None), _type=no_ref))
        edges = instances(
            line, "supply", edge_key, F.col("l_linenumber"), type=ref("types", text("flag-", F.col("l_returnflag"))),
            startNode=ref("parts", text("part-", F.col("l_partkey"))),
            endNode=ref("suppliers", text("supplier-", F.col("l_suppkey"))),
        )
        properties = {
            "Part": part.select(
                F.lit("parts").alias("space"), part_key.alias("externalId"), F.col("p_name").alias("name"),
                F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
            ),
            "Supplier": supplier.select(
                F.lit("suppliers").alias("space"), supplier_key.alias("externalId"), F.col("s_name").alias("name"),
                F.col("s_acctbal").alias("balance"), ref("parts", text("part-", F.col("s_suppkey"))).alias("favourite"),
            ),
            "Supply": line.select(
                F.lit("supply").alias("space"), edge_key.alias("externalId"), F.col("l_quantity").alias("quantity"),
                F.col("l_discount").alias("discount"),
            ),
        }
        views = {v.external_id: v for v in (PART_VIEW, SUPPLIER_VIEW, SUPPLY_VIEW)}
        model = DataModel("models", "Trade", "1", tuple(views.values()))
        later = DataModel("models", "Trade", "2", (PART_VIEW_2, ViewRef("models", "Supplier", "1")))
        return Graph(nodes, edges, properties, views, [model, later])
