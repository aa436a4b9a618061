"""Nodes and edges with view-defined properties.

Instances live in a node table and an edge table, keyed by (space, externalId); each view has a table
of its properties with the same key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..functions.convert import json_is_valid, narrow_exact
from ..session import cut_lineage
from .models import (  # the definitions are read from here as well
    KEY,
    PROPERTY_TYPES,
    REFERENCE,
    Connection,
    DataModel,
    Graph,
    Property,
    View,
    ViewRef,
    find_connection,
    find_in_model,
    find_view,
    property_table,
    read_columns,
    written_properties,
)
from .skew import has_hot_key, keep_greatest

__all__ = ["KEY", "REFERENCE", "Connection", "DataModel", "Graph", "Property", "View", "ViewRef"]

# Up to so many written rows the stored tables are joined with them where they lie; above, both are dealt by key once.
SMALL_SOURCE = 100_000

def _reference_field(name: str, nullable: bool) -> T.StructField:
    return T.StructField(name, REFERENCE, nullable)


def view_schema(view: View | None, usage: str, sync: bool = False) -> T.StructType:
    """Columns of a scan: the view's properties, then the attributes of the instance kind."""
    fields = [T.StructField(p.name, p.data_type(), p.nullable) for p in (view.properties if view else ())]
    fields += [T.StructField("space", T.StringType(), False), T.StructField("externalId", T.StringType(), False)]
    for kind in ("node", "edge"):
        if usage in (kind, "all"):
            fields += [
                T.StructField(f"{kind}.{name}", T.LongType())
                for name in ("version", "createdTime", "lastUpdatedTime", "deletedTime")
            ]
    if usage in ("edge", "all"):
        fields.append(_reference_field("type", True))
    fields.append(_reference_field("_type", usage != "edge"))
    if usage in ("edge", "all"):
        fields += [_reference_field("startNode", usage == "all"), _reference_field("endNode", usage == "all")]
    if sync:
        fields.append(T.StructField("metadata.cursor", T.StringType()))
    return T.StructType(fields)


def _attributes(kind: str) -> list[Column]:
    return [
        F.coalesce("version", F.lit(-1)).cast("long").alias(f"{kind}.version"),
        F.col("createdTime").alias(f"{kind}.createdTime"),
        F.col("lastUpdatedTime").alias(f"{kind}.lastUpdatedTime"),
        F.coalesce("deletedTime", F.lit(0)).cast("long").alias(f"{kind}.deletedTime"),
    ]


def scan_instances(
    graph: Graph,
    usage: str | None = None,
    view: str | View | None = None,
    edge_type: tuple[str, str] | None = None,
    instance_space: str | None = None,
) -> DataFrame:
    """Nodes, edges or both; with a view (or the name of one), those that have data in it, with its properties.

    ``edge_type`` reads the edges of one (space, externalId) type.
    """
    if edge_type is not None:
        found = graph.edges.filter(
            (F.col("type.space") == edge_type[0]) & (F.col("type.externalId") == edge_type[1])
        )
        return _in_space(found, instance_space).select("space", "externalId", "startNode", "endNode")
    definition = find_view(graph, view) if isinstance(view, str) else view
    if definition is not None:
        usage = usage or definition.used_for
        if definition.used_for not in ("all", usage):
            raise PlantError(f"View {definition.id} is used for {definition.used_for}, not for {usage}")
    if usage not in ("node", "edge", "all"):
        raise PlantError(f"usage must be node, edge or all, not {usage}")
    parts = []
    if usage in ("node", "all"):
        parts.append(_with_view(graph, _in_space(graph.nodes, instance_space), "node", definition))
    if usage in ("edge", "all"):
        parts.append(_with_view(graph, _in_space(graph.edges, instance_space), "edge", definition))
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    schema = view_schema(definition, usage)
    return whole.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])


def _in_space(df: DataFrame, space: str | None) -> DataFrame:
    return df if space is None else df.filter(F.col("space") == space)


def _with_view(graph: Graph, instances: DataFrame, kind: str, view: View | None) -> DataFrame:
    columns = [*KEY, *_attributes(kind)]
    if kind == "edge":
        columns += ["type", F.col("type").alias("_type"), "startNode", "endNode"]
    else:
        columns += ["_type"]
    base = instances.select(*columns)
    if view is None:
        return base
    table = property_table(graph, view)
    return base.join(table.select(*KEY, *read_columns(view, table)), KEY)


def scan_model(
    graph: Graph,
    model: tuple[str, str, str],
    view: str,
    connection: str | None = None,
    instance_space: str | None = None,
) -> DataFrame:
    """Scan through a data model: a view of the model, or the edges behind one of its connections."""
    if connection is None:
        definition = find_in_model(graph, model, view)
        return scan_instances(graph, definition.used_for, definition, instance_space=instance_space)
    edges = find_connection(graph, model, view, connection)
    return scan_instances(graph, edge_type=(edges.edge_space, edges.edge_type), instance_space=instance_space)


def has_data(instances: DataFrame, properties: DataFrame) -> DataFrame:
    """Instances with data in a view."""
    return instances.join(properties.select(*KEY), KEY, "left_semi")


def _ref(df: DataFrame, name: str, default_space: Column) -> Column:
    """A complete reference from a struct column, its space filled in; null when incomplete."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, T.StructType):
        return F.lit(None).cast(REFERENCE)
    fields = df.schema[name].dataType.fieldNames()
    spaces = [F.col(name).getField(s) for s in ("space", "spaceExternalId") if s in fields]
    space = F.coalesce(*spaces, default_space).cast("string")
    external_id = F.col(name).getField("externalId").cast("string") if "externalId" in fields else F.lit(None)
    made = F.struct(space.alias("space"), external_id.cast("string").alias("externalId"))
    return F.when(space.isNotNull() & external_id.isNotNull(), made)


def _space(df: DataFrame, instance_space: str | None) -> Column:
    if instance_space is not None:
        return F.lit(instance_space)
    return F.col("space").cast("string") if "space" in df.columns else F.lit(None).cast("string")


def _prepared(df: DataFrame, instance_space: str | None) -> DataFrame:
    """Rows with key and complete references in ``_ref_*`` columns, and ``_error`` for a missing key."""
    space = _space(df, instance_space)
    key = F.col("externalId").cast("string") if "externalId" in df.columns else F.lit(None).cast("string")
    node_type = _ref(df, "_type", space)
    return df.select(
        "*",
        space.alias("_space"),
        key.alias("_externalId"),
        node_type.alias("_ref_node_type"),
        F.coalesce(node_type, _ref(df, "type", space)).alias("_ref_type"),
        _ref(df, "startNode", space).alias("_ref_start"),
        _ref(df, "endNode", space).alias("_ref_end"),
        F.when(key.isNull(), "'externalId' is null").when(space.isNull(), "'space' is null").alias("_error"),
    )


def classify_instances(df: DataFrame, instance_space: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split a mixed frame: all of type, startNode, endNode make an edge; neither end makes a node."""
    work = _prepared(df, instance_space)
    is_edge = F.col("_ref_type").isNotNull() & F.col("_ref_start").isNotNull() & F.col("_ref_end").isNotNull()
    is_node = F.col("_ref_start").isNull() & F.col("_ref_end").isNull()
    found = F.concat_ws(
        ", ",
        F.when(F.col("_ref_type").isNotNull(), "'type'"),
        F.when(F.col("_ref_start").isNotNull(), "'startNode'"),
        F.when(F.col("_ref_end").isNotNull(), "'endNode'"),
    )
    text = F.concat(
        F.lit("neither a node nor an edge, it has only: 'externalId', "),
        found,
    )
    judged = work.withColumn("_error", F.coalesce("_error", F.when(~is_edge & ~is_node, text)))
    good = judged.filter("_error is null")
    special = {"space", "externalId", "_type", "type", "startNode", "endNode"}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in special]
    key = [F.col("_space").alias("space"), F.col("_externalId").alias("externalId")]
    nodes = good.filter(is_node).select(*key, F.col("_ref_node_type").alias("_type"), *rest)
    edges = good.filter(is_edge).select(
        *key, F.col("_ref_type").alias("type"), F.col("_ref_start").alias("startNode"), F.col("_ref_end").alias("endNode"), *rest
    )
    errors = judged.filter("_error is not null").select(*key, F.col("_error").alias("error"))
    return nodes, edges, errors


@dataclass
class InstanceResult:
    """Tables after an upsert; ``changes`` says created, modified or noop per instance."""

    instances: DataFrame
    properties: DataFrame | None
    changes: DataFrame
    errors: DataFrame
    # After a write of edges: the nodes, with placeholders for the missing ones.
    nodes: DataFrame | None = None
    # Instances that have data in the view, with their properties.
    joined: DataFrame | None = None


def _property_value(df: DataFrame, prop: Property, space: Column) -> tuple[Column, Column]:
    """A written value in the property's type, and the error it causes or null."""
    value, given = F.col(f"`{prop.name}`"), df.schema[prop.name].dataType
    message = F.lit(f"bad value of '{prop.name}'")
    none = F.lit(None).cast("string")
    if prop.is_list:
        compact = F.array_compact(value)
        if prop.kind == "direct":
            filled = F.transform(
                compact,
                lambda r: F.struct(F.coalesce(r["space"], space).alias("space"), r["externalId"].alias("externalId")),
            )
            bad = F.exists(filled, lambda r: r["space"].isNull() | r["externalId"].isNull())
            return filled, F.when(bad, message)
        if prop.kind in ("int32", "int64", "float32", "float64"):
            kind = PROPERTY_TYPES[prop.kind]
            bad = F.exists(compact, lambda x: narrow_exact(x, kind)[1])
            return F.transform(compact, lambda x: narrow_exact(x, kind)[0]), F.when(bad, message)
        if prop.kind == "json":
            return compact, F.when(F.exists(compact, lambda x: ~json_is_valid(x)), message)
        return compact.cast(T.ArrayType(PROPERTY_TYPES[prop.kind])), none
    if prop.kind == "direct":
        made = _ref(df, prop.name, space)
        return made, F.when(value.isNotNull() & made.isNull(), message)
    if prop.kind in ("int32", "int64", "float32", "float64"):
        found, bad = narrow_exact(value, PROPERTY_TYPES[prop.kind])
        return found, F.when(bad, message)
    if prop.kind == "json":
        return value, F.when(value.isNotNull() & ~json_is_valid(value), message)
    if prop.kind in ("timestamp", "date") and isinstance(given, T.StringType):
        from ..functions.convert import parse_date, parse_timestamp

        found = parse_timestamp(value) if prop.kind == "timestamp" else parse_date(value)
        return found, F.when(value.isNotNull() & found.isNull(), message)
    return value.cast(PROPERTY_TYPES[prop.kind]), none


def upsert_instances(
    instances: DataFrame,
    source: DataFrame,
    kind: str,
    view: View | None = None,
    properties: DataFrame | None = None,
    *,
    instance_space: str | None = None,
    edge_type: tuple[str, str] | None = None,
    ignore_null_fields: bool = True,
    now: datetime | None = None,
) -> InstanceResult:
    """Create or change nodes or edges and their view properties; what a row does not mention stays.

    ``edge_type`` gives every edge that type, whatever the rows say.
    """
    written = written_properties(view, source, properties) if view else []
    if view:
        lacking = [p.name for p in view.properties if not p.nullable and p.name not in source.columns]
        if lacking:
            raise PlantError(f"missing required properties: [{', '.join(lacking)}]")
    work = _prepared(source, instance_space)
    error = F.col("_error")
    if edge_type is not None:
        literal = F.struct(F.lit(edge_type[0]).alias("space"), F.lit(edge_type[1]).alias("externalId"))
        work = work.withColumn("_ref_type", literal)
    if kind == "edge":
        for name, column in (("type", "_ref_type"), ("startNode", "_ref_start"), ("endNode", "_ref_end")):
            error = F.coalesce(error, F.when(F.col(column).isNull(), f"'{name}' is incomplete"))
        references = [("type", "_ref_type"), ("startNode", "_ref_start"), ("endNode", "_ref_end")]
    else:
        references = [("_type", "_ref_node_type")]
    values = {}
    for prop in written:
        value, bad = _property_value(source, prop, F.col("_space"))
        values[prop.column] = value
        error = F.coalesce(error, bad)
        if not prop.nullable:
            error = F.coalesce(error, F.when(F.col(f"`{prop.name}`").isNull(), f"'{prop.name}' is null"))
    judged = work.select(
        F.col("_space").alias("space"),
        F.col("_externalId").alias("externalId"),
        *[F.col(column).alias(name) for name, column in references],
        *[value.alias(name) for name, value in values.items()],
        error.alias("_error"),
    )
    errors = judged.filter("_error is not null").select(*KEY, F.col("_error").alias("error"))
    good = judged.filter("_error is null").drop("_error")
    names = [name for name, _ in references]
    stamp = F.unix_millis(F.current_timestamp() if now is None else F.lit(now))
    written_rows, hot = has_hot_key(good, KEY)
    if written_rows > SMALL_SOURCE:
        # Copies of a hot key collapse before they travel; others do so where the tables meet.
        rows = keep_greatest(good, KEY) if hot else good
        return _upsert_together(instances, properties, rows, names, list(values), ignore_null_fields, stamp, errors)
    rows = cut_lineage(keep_greatest(good, KEY))
    new = rows.select(*KEY, F.struct(*[F.col(c) for c in [*names, *values]]).alias("_new"))
    old = instances.select(*KEY, F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in names])
    held = None if properties is None else properties.select(*KEY, *[F.col(c).alias(f"_old_{c}") for c in values])
    # The tables are first cut down to the written keys. The size of these is known, so Spark copies a small set.
    keys = rows.select(*KEY)
    old = old.join(keys, KEY, "left_semi")
    if held is not None:
        old = old.join(held.join(keys, KEY, "left_semi"), KEY, "left")
    merged, same = _merged({n: F.col(f"_old_{n}") for n in [*names, *values]}, names, ignore_null_fields)
    # Read for the instances, for the properties and for the changes, so it is written once.
    resolved = cut_lineage(
        new.join(old, KEY, "left").select(
            *KEY,
            *[v.alias(n) for n, v in merged.items()],
            F.when(F.col("_known").isNull(), "created").when(same, "noop").otherwise("modified").alias("change"),
        )
    )
    after = _write_instances(instances, resolved, names, stamp)
    held_after = None if properties is None else _write_properties(properties, resolved, list(values))
    joined = None if properties is None else after.join(held_after, KEY)
    return InstanceResult(after, held_after, resolved.select(*KEY, "change"), errors, joined=joined)


def _merged(old: dict[str, Column], names: Sequence[str], ignore_null_fields: bool) -> tuple[dict[str, Column], Column]:
    """The values after a write of the struct ``_new`` over the old ones, and whether nothing changes."""
    merged, same = {}, F.lit(True)
    for name, before in old.items():
        value = F.col("_new").getField(name)
        merged[name] = F.coalesce(value, before) if ignore_null_fields or name in names else value
        same = same & merged[name].eqNullSafe(before)
    return merged, same


def _upsert_together(
    instances: DataFrame, properties: DataFrame | None, rows: DataFrame, names: list[str], values: list[str],
    ignore_null_fields: bool, stamp: Column, errors: DataFrame,
) -> InstanceResult:
    """An upsert that may touch much of the tables: written rows, instances and properties are dealt by key once, and
    all results are read from one table of what comes out."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*KEY, F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in KEY]).alias(name))

    sides = [packed(rows, "_new"), packed(instances, "_inst")]
    if properties is not None:
        sides.append(packed(properties, "_prop"))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    held = [c for c in ("_inst", "_prop") if c in whole.columns]
    # Dealt before they are aggregated, as hardly any row meets another one of its key on the way.
    met = whole.repartition(*KEY).groupBy(*KEY).agg(
        F.max("_new").alias("_new"),
        *[F.first(c, ignorenulls=True).alias(c) for c in held],
        F.greatest(F.lit(0), *[F.count(c) for c in held]).alias("_copies"),
    )
    twice = F.raise_error(F.concat(F.lit("a stored table holds a key twice: "), F.concat_ws(", ", *KEY)))
    met = met.withColumn("_new", F.when(F.col("_copies") > 1, twice.cast(met.schema["_new"].dataType)).otherwise(F.col("_new")))
    known, written = F.col("_inst").isNotNull(), F.col("_new").isNotNull()
    old = {n: F.col("_inst").getField(n) for n in names}
    old |= {n: F.when(known, F.col("_prop").getField(n)) for n in values}
    merged, same = _merged(old, names, ignore_null_fields)
    change = F.when(written, F.when(~known, "created").when(same, "noop").otherwise("modified"))
    hit = F.coalesce(F.col("change") != "noop", F.lit(False))

    stamps = {
        "version": lambda before: F.coalesce(before, F.lit(0)) + 1,
        "createdTime": lambda before: F.when(known, before).otherwise(stamp),
        "lastUpdatedTime": lambda _: stamp,
    }

    def attribute(name: str) -> Column:
        before = F.col("_inst").getField(name)
        if name in names:
            return F.when(hit, merged[name]).otherwise(before).alias(name)
        if name in stamps:
            return F.when(hit, stamps[name](before).cast(instances.schema[name].dataType)).otherwise(before).alias(name)
        return before.alias(name)

    def value(name: str) -> Column:
        before = F.col("_prop").getField(name)
        return (F.when(written, merged[name]).otherwise(before) if name in values else before).alias(name)

    columns = [c for c in instances.columns if c not in KEY]
    made = [F.when(known | written, F.struct(*[attribute(c) for c in columns])).alias("_after")]
    if properties is not None:
        held_columns = [c for c in properties.columns if c not in KEY]
        present = F.col("_prop").isNotNull() | written
        made.append(F.when(present, F.struct(*[value(c) for c in held_columns])).alias("_held"))
    state = cut_lineage(met.withColumn("change", change).select(*KEY, "change", *made))

    def unpacked(like: DataFrame, name: str) -> list[Column]:
        return [F.col(c) if c in KEY else F.col(name).getField(c).alias(c) for c in like.columns]

    after = state.filter("_after is not null")
    result = InstanceResult(
        after.select(*unpacked(instances, "_after")), None, state.filter("change is not null").select(*KEY, "change"), errors
    )
    if properties is not None:
        result.properties = state.filter("_held is not null").select(*unpacked(properties, "_held"))
        more = [F.col("_held").getField(c).alias(c) for c in held_columns]
        result.joined = after.filter("_held is not null").select(*KEY, *[F.col("_after").getField(c).alias(c) for c in columns], *more)
    return result


def _write_instances(instances: DataFrame, resolved: DataFrame, names: list[str], stamp: Column) -> DataFrame:
    fresh = resolved.filter("change <> 'noop'").select(*KEY, F.struct(*names, "change").alias("_new"))
    joined = instances.join(fresh, KEY, "left")
    hit = F.col("_new").isNotNull()

    def field(name: str) -> Column:
        if name in names:
            return F.when(hit, F.col("_new").getField(name)).otherwise(F.col(name)).alias(name)
        if name == "version":
            return F.when(hit, F.coalesce("version", F.lit(0)) + 1).otherwise(F.col("version")).alias("version")
        if name == "lastUpdatedTime":
            return F.when(hit, stamp).otherwise(F.col(name)).alias(name)
        return F.col(name)

    kept = joined.select(*[field(c) for c in instances.columns])
    made = {"version": F.lit(1).cast("long"), "createdTime": stamp, "lastUpdatedTime": stamp}
    created = resolved.filter("change = 'created'").select(
        *[
            F.col(c) if c in KEY or c in names else made.get(c, F.lit(None)).cast(instances.schema[c].dataType).alias(c)
            for c in instances.columns
        ]
    )
    return kept.unionByName(created)


def _write_properties(properties: DataFrame, resolved: DataFrame, names: list[str]) -> DataFrame:
    new = resolved.select(*KEY, F.struct(*names).alias("_new"))
    hit = F.col("_new").isNotNull()
    kept = properties.join(new, KEY, "left").select(
        *[
            F.when(hit, F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
            for c in properties.columns
        ]
    )
    present = properties.select(*KEY).join(resolved.select(*KEY), KEY, "left_semi")
    added = resolved.select(*KEY, *names).join(present, KEY, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True)


def delete_instances(instances: DataFrame, source: DataFrame, instance_space: str | None = None) -> DataFrame:
    keys = source.select(_space(source, instance_space).alias("space"), F.col("externalId").cast("string").alias("externalId"))
    return instances.join(keys.distinct(), KEY, "left_anti")


def missing_references(
    source: DataFrame, nodes: DataFrame, columns: Sequence[str], instance_space: str | None = None
) -> DataFrame:
    """Referenced nodes that do not exist: (space, externalId), each once."""
    space = _space(source, instance_space)
    refs = []
    for name in columns:
        data_type = source.schema[name].dataType
        if isinstance(data_type, T.ArrayType):
            one = source.select(space.alias("_space"), F.explode(name).alias("r")).select(
                F.coalesce("r.space", "_space").alias("space"), F.col("r.externalId").alias("externalId")
            )
        else:
            one = source.select(_ref(source, name, space).alias("r")).select("r.space", "r.externalId")
        refs.append(one.filter("externalId is not null"))
    total = refs[0]
    for part in refs[1:]:
        total = total.unionByName(part)
    return total.distinct().join(nodes.select(*KEY), KEY, "left_anti")


def auto_create_nodes(
    source: DataFrame,
    nodes: DataFrame,
    *,
    start_nodes: bool = True,
    end_nodes: bool = True,
    direct_relations: Sequence[str] = (),
    auto_create_direct_relations: bool = True,
    instance_space: str | None = None,
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Nodes with placeholders for missing references, and the references that may not be created."""
    create, refuse = [], []
    for name, wanted in (("startNode", start_nodes), ("endNode", end_nodes)):
        if name in source.columns:
            (create if wanted else refuse).append(name)
    for name in direct_relations:
        (create if auto_create_direct_relations else refuse).append(name)
    stamp = F.unix_millis(F.current_timestamp() if now is None else F.lit(now))
    result = nodes
    if create:
        made = {"version": F.lit(1), "createdTime": stamp, "lastUpdatedTime": stamp}
        absent = missing_references(source, nodes, create, instance_space)
        result = nodes.unionByName(
            absent.select(
                *[
                    F.col(c) if c in KEY else made.get(c, F.lit(None)).cast(nodes.schema[c].dataType).alias(c)
                    for c in nodes.columns
                ]
            )
        )
    if refuse:
        errors = missing_references(source, result, refuse, instance_space)
    else:
        errors = nodes.select(*KEY).limit(0)
    return result, errors
