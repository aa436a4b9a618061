"""Resources addressed by options, for programs that say ``type``, ``onconflict`` and so on.

``read`` and ``write`` choose the operator an option set stands for. Options about transport, retries,
batches and metrics have no effect here and are accepted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import PlantError
from .functions.rawjson import drop_null_fields, infer_json_schema, insert_rows, read_json_table
from .operators.graph import (
    KEY,
    Graph,
    InstanceResult,
    View,
    auto_create_nodes,
    classify_instances,
    delete_instances,
    scan_instances,
    upsert_instances,
)
from .operators.hierarchy import delete_subtrees, reconcile_hierarchy
from .operators.merge import merge
from .operators.models import find_connection, find_in_model, find_view, property_table
from .operators.predicates import parse_ids
from .operators.series_writes import (
    delete_ranges,
    delete_sequence_rows,
    resolve_series,
    sequence_rows,
    upsert_points,
    upsert_sequence_rows,
)
from .operators.sync import parse_cursor, sync
from .sources.catalog import Catalog
from .sources.files import FILE_LIMIT, LINE_LIMIT, limit_errors, read_file_content

_POINTS = ("datapoints", "stringdatapoints")


def _flag(options: Mapping[str, object], name: str, default: bool) -> bool:
    text = str(options.get(name, default)).lower()
    if text not in ("true", "false"):
        raise PlantError(f"{name} is neither true nor false")
    return text == "true"


def _required(options: Mapping[str, object], name: str) -> str:
    if name not in options:
        raise PlantError(f"option {name} is missing")
    return str(options[name])


def _subtrees(options: Mapping[str, object]) -> str:
    if "ignoreDisconnectedAssets" in options and "subtrees" in options:
        raise PlantError("ignoreDisconnectedAssets and subtrees exclude each other")
    if "ignoreDisconnectedAssets" in options:
        return "ignore" if _flag(options, "ignoreDisconnectedAssets", False) else "error"
    return str(options.get("subtrees", "ingest")).lower()


def _texts(value: object) -> list[str]:
    return [] if value is None else [value] if isinstance(value, str) else [str(v) for v in value]


@dataclass
class Workspace:
    """A catalog, and where graphs, JSON tables and file contents are found."""

    catalog: Catalog
    graph: Graph | None = None
    raw_tables: Mapping[tuple[str, str], Callable[[], DataFrame]] = field(default_factory=dict)
    file_paths: Mapping[str, str] = field(default_factory=dict)

    def read(self, *, schema: T.StructType | None = None, **options: object) -> DataFrame:
        kind = _required(options, "type")
        if kind == "assethierarchy":
            raise PlantError("assethierarchy can only be written")
        if kind == "raw":
            return self._read_raw(options, schema)
        if kind == "filecontent":
            return self._read_file(options)
        if kind == "instances":
            return self._read_instances(options)
        if kind == "sequencerows":
            columns = self._sequence_columns(options)
            rows = self.catalog.scan("sequencerows", where=self._one_sequence(options))
            return sequence_rows(rows, columns)
        if kind in _POINTS and {"id", "externalId"} & options.keys():
            ids, external_ids = parse_ids(str(options["id"])) if "id" in options else ([], [])
            return self.catalog.points(kind, ids=ids, external_ids=[*external_ids, *_texts(options.get("externalId"))])
        subtree = options.get("assetSubtreeIds") if kind == "assets" else None
        numbers = {"model_id": "modelId", "revision_id": "revisionId"}
        chosen = {name: int(str(options[o])) for name, o in numbers.items() if kind.startswith("3d") and o in options}
        filled = kind == "assets" and _flag(options, "aggregates", False)
        return self.catalog.scan(kind, asset_subtree_ids=subtree, aggregates=filled, **chosen)

    def _raw(self, options: Mapping[str, object]) -> DataFrame:
        name = (_required(options, "database"), _required(options, "table"))
        if name not in self.raw_tables:
            raise PlantError(f"Unknown raw table {name[0]}.{name[1]}")
        return self.raw_tables[name]()

    def _read_raw(self, options: Mapping[str, object], schema: T.StructType | None) -> DataFrame:
        rows = self._raw(options)
        if schema is None and _flag(options, "inferSchema", False):
            limit = options.get("inferSchemaLimit")
            schema = infer_json_schema(rows, **({"limit": int(str(limit))} if limit is not None else {}))
        if schema is not None:
            return read_json_table(rows, schema, on_error="raise")
        if _flag(options, "filterNullFieldsOnNonSchemaRawQueries", False):
            return rows.withColumn("columns", drop_null_fields())
        return rows

    def _read_file(self, options: Mapping[str, object]) -> DataFrame:
        name = _required(options, "externalId")
        if name not in self.file_paths:
            raise PlantError(f"Unknown file {name}")
        spark, path = self.catalog.spark, self.file_paths[name]
        # The check reads the whole content once more, so it is made on request only.
        wrong = limit_errors(spark, path, FILE_LIMIT, LINE_LIMIT).first() if _flag(options, "checkLimits", False) else None
        if wrong:
            raise PlantError(f"{name}: {wrong['error']}")
        return read_file_content(spark, path, _flag(options, "inferSchema", True))

    def _graph(self) -> Graph:
        if self.graph is None:
            raise PlantError("this workspace has no instances")
        return self.graph

    def _view(self, options: Mapping[str, object]) -> View | None:
        """The view that ``viewExternalId`` names, by ``viewSpace`` and ``viewVersion`` where they are given."""
        if options.get("viewExternalId") is None:
            return None
        place = [None if options.get(o) is None else str(options[o]) for o in ("viewSpace", "viewVersion")]
        return find_view(self._graph(), str(options["viewExternalId"]), *place)

    def _instance_target(self, options: Mapping[str, object]) -> tuple[str, View | None, tuple[str, str] | None]:
        """What options mean: an instance kind, a view and an edge type.

        The first of these that is given decides: a kind with a cursor, an edge type, a kind, a data model (whose
        cursor comes before a connection). A data model says which space and version of a view is meant.
        """
        kind = options.get("instanceType")
        if kind and "cursor" in options:
            return str(kind), self._view(options), None
        if "edgeTypeSpace" in options and "edgeTypeExternalId" in options:
            return "edge", None, (str(options["edgeTypeSpace"]), str(options["edgeTypeExternalId"]))
        if kind:
            return str(kind), self._view(options), None
        if not all(o in options for o in ("modelSpace", "modelExternalId", "modelVersion", "viewExternalId")):
            raise PlantError("instances need an instanceType, an edge type, or a data model with a view")
        graph, name = self._graph(), str(options["viewExternalId"])
        model = tuple(str(options[o]) for o in ("modelSpace", "modelExternalId", "modelVersion"))
        if "connectionPropertyName" in options and "cursor" not in options:
            edges = find_connection(graph, model, name, str(options["connectionPropertyName"]))
            return "edge", None, (edges.edge_space, edges.edge_type)
        view = find_in_model(graph, model, name)
        return view.used_for, view, None

    def _read_instances(self, options: Mapping[str, object]) -> DataFrame:
        kind, view, edge_type = self._instance_target(options)
        rows = scan_instances(self._graph(), kind, view, edge_type, options.get("instanceSpace"))
        return self._synced(rows, kind, options) if "cursor" in options and edge_type is None else rows

    def _synced(self, rows: DataFrame, kind: str, options: Mapping[str, object]) -> DataFrame:
        if kind == "all":
            raise PlantError("a sync reads nodes or edges, not both")
        cursor = str(options["cursor"]) or None
        if cursor:
            # On the stored column, so that it reaches the files below the view's join.
            rows = rows.filter(F.col(f"`{kind}.lastUpdatedTime`") >= parse_cursor(cursor)[0] // 1000)
        work = rows.withColumn("_time", F.timestamp_millis(f"`{kind}.lastUpdatedTime`")).withColumn(
            "_item", F.concat_ws("/", "space", "externalId")
        )
        found, _ = sync(work, cursor, time="_time", item="_item")
        return found.drop("_time", "_item")

    def _one_sequence(self, options: Mapping[str, object]):
        if "id" in options:
            return F.col("id") == int(str(options["id"]))
        return F.col("externalId") == _required(options, "externalId")

    def _sequence_columns(self, options: Mapping[str, object]) -> list[tuple[str, str]]:
        found = self.catalog.scan("sequences", where=self._one_sequence(options), columns=["columns"]).first()
        if found is None:
            raise PlantError("Unknown sequence")
        return [(c["externalId"], c["valueType"]) for c in found["columns"]]

    def write(self, df: DataFrame, **options: object):
        """The outcome of a write: a merge result, or the new table where rows can not be refused."""
        kind, mode = _required(options, "type"), str(options.get("onconflict", "abort")).lower()
        keep_null = _flag(options, "ignoreNullFields", True)
        if mode not in ("abort", "update", "upsert", "delete", "insert_into"):
            raise PlantError(f"`{mode}` is not a valid onconflict option")
        if kind in _POINTS:
            return self._write_points(df, kind, mode)
        if kind == "sequencerows":
            return self._write_sequence_rows(df, mode, options)
        if kind == "raw":
            return insert_rows(self._raw(options), df)
        if kind == "assethierarchy":
            target = self.catalog.scan("assets")
            if mode == "delete":
                return delete_subtrees(target, df)
            return reconcile_hierarchy(
                target, df, _subtrees(options), _flag(options, "deleteMissingAssets", False), keep_null
            )
        if kind == "instances":
            return self._write_instances(df, mode, keep_null, options)
        return merge(
            self.catalog.scan(kind), df, kind, mode,
            ignore_null_fields=keep_null, ignore_unknown_ids=_flag(options, "ignoreUnknownIds", True),
        )

    def _write_points(self, df: DataFrame, kind: str, mode: str):
        target = self.catalog.scan(kind)
        if mode == "delete":
            return delete_ranges(target, df)
        if mode == "update":
            raise PlantError(f"{kind} take upsert, not update")
        series = self.catalog.scan("timeseries", columns=["id", "externalId"])
        rows, errors = resolve_series(df, series)
        named = rows.join(series, "id", "left")
        return upsert_points(target, named.select(*target.columns)), errors

    def _write_sequence_rows(self, df: DataFrame, mode: str, options: Mapping[str, object]) -> DataFrame:
        target = self.catalog.scan("sequencerows")
        key = "id" if "id" in df.columns else "externalId"
        if mode == "delete":
            return delete_sequence_rows(target, df, (key, "rowNumber"))
        if mode != "upsert":
            raise PlantError(f"sequencerows take upsert, not {mode}")
        return upsert_sequence_rows(target, df, self._sequence_columns(options), key)

    def _write_instances(self, df: DataFrame, mode: str, keep_null: bool, options: Mapping[str, object]):
        graph, space = self._graph(), options.get("instanceSpace")
        kind, view, edge_type = self._instance_target({k: v for k, v in options.items() if k != "cursor"})
        if kind == "all":
            return self._write_mixed(df, mode, keep_null, options, view)
        table = graph.edges if kind == "edge" else graph.nodes
        if mode == "delete":
            return delete_instances(table, df, space)
        if mode != "upsert":
            raise PlantError(f"instances take upsert, not {mode}")
        properties = property_table(graph, view) if view else None
        return self._upsert(df, kind, keep_null, options, graph.nodes, view, properties, edge_type)

    def _write_mixed(self, df: DataFrame, mode: str, keep_null: bool, options: Mapping[str, object], view: View | None):
        """Nodes and edges in one frame: the results for nodes and for edges, and the rows that are neither.

        A delete gives the nodes and the edges that stay.
        """
        graph, space = self._graph(), options.get("instanceSpace")
        if mode == "delete":
            return delete_instances(graph.nodes, df, space), delete_instances(graph.edges, df, space)
        if mode != "upsert":
            raise PlantError(f"instances take upsert, not {mode}")
        nodes, edges, errors = classify_instances(df, space)
        first = self._upsert(nodes, "node", keep_null, options, graph.nodes, view, property_table(graph, view) if view else None)
        return first, self._upsert(edges, "edge", keep_null, options, first.instances, view, first.properties), errors

    def _upsert(
        self, df: DataFrame, kind: str, keep_null: bool, options: Mapping[str, object], nodes: DataFrame,
        view: View | None, properties: DataFrame | None, edge_type: tuple[str, str] | None = None,
    ) -> InstanceResult:
        """An upsert with the nodes it refers to: missing ones get placeholders, or are errors where options forbid them."""
        graph, space = self._graph(), options.get("instanceSpace")
        result = upsert_instances(
            graph.edges if kind == "edge" else nodes, df, kind, view, properties,
            instance_space=space, edge_type=edge_type, ignore_null_fields=keep_null,
        )
        direct = [p.name for p in (view.properties if view else ()) if p.kind == "direct" and p.name in df.columns]
        known, refused = auto_create_nodes(
            df if kind == "edge" else df.drop("startNode", "endNode"), nodes if kind == "edge" else result.instances,
            start_nodes=_flag(options, "autoCreateStartNodes", True), end_nodes=_flag(options, "autoCreateEndNodes", True),
            direct_relations=direct, auto_create_direct_relations=_flag(options, "autoCreateDirectRelations", True),
            instance_space=space,
        )
        absent = refused.select(*KEY, F.lit("a row refers to this node, which does not exist").alias("error"))
        result.errors = result.errors.unionByName(absent)
        if kind == "edge":
            result.nodes = known
        else:
            result.instances = known
        return result
