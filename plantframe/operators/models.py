"""Views and data models by space, name and version, and how a view's properties lie in stored tables.

Several versions of a view may read the same table under other names and types: a property names its stored column,
and values are converted on the way. Names are resolved on the driver, as definitions are few; rows stay in tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..functions.convert import read_cast

KEY = ["space", "externalId"]
REFERENCE = T.StructType([T.StructField("space", T.StringType()), T.StructField("externalId", T.StringType())])

# Property kinds and the types they are read as.
PROPERTY_TYPES = {
    "text": T.StringType(),
    "enum": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "json": T.StringType(),
    "timeseries": T.StringType(),
    "file": T.StringType(),
    "sequence": T.StringType(),
    "direct": REFERENCE,
}
_NUMBERS = {"int32", "int64", "float32", "float64"}
# Pairs of kinds (narrow, wide) where every value of the first one is a value of the second.
_WIDER = {("int32", "int64"), ("int32", "float64"), ("float32", "float64")}


@dataclass(frozen=True)
class Property:
    """A property; ``stored`` is its column in the view's table where that has another name."""

    name: str
    kind: str
    is_list: bool = False
    nullable: bool = True
    stored: str | None = None

    def data_type(self) -> T.DataType:
        one = PROPERTY_TYPES[self.kind]
        return T.ArrayType(one, self.nullable) if self.is_list else one

    @property
    def column(self) -> str:
        return self.stored or self.name


@dataclass(frozen=True)
class Connection:
    """A view property that stands for the edges of one type."""

    name: str
    edge_space: str
    edge_type: str


@dataclass(frozen=True)
class View:
    space: str
    external_id: str
    version: str
    used_for: str
    properties: tuple[Property, ...] = ()
    connections: tuple[Connection, ...] = ()

    @property
    def id(self) -> tuple[str, str, str]:
        return self.space, self.external_id, self.version


@dataclass(frozen=True)
class ViewRef:
    """A view that a data model names without defining it."""

    space: str
    external_id: str
    version: str


@dataclass(frozen=True)
class DataModel:
    space: str
    external_id: str
    version: str
    views: tuple[View | ViewRef, ...]


@dataclass
class Graph:
    """Instance tables, property tables, views and data models.

    ``views`` says which view a name alone stands for. A property table is found by the view's (space, name, version),
    or else by its name, so that versions can share one.
    """

    nodes: DataFrame
    edges: DataFrame
    properties: Mapping[str | tuple[str, str, str], DataFrame] = field(default_factory=dict)
    views: Mapping[str, View] = field(default_factory=dict)
    models: Sequence[DataModel] = ()

    def known_views(self) -> dict[tuple[str, str, str], View]:
        """All views by (space, name, version), those defined inside data models included."""
        found: dict[tuple[str, str, str], View] = {}
        inline = [v for m in self.models for v in m.views if isinstance(v, View)]
        for view in [*self.views.values(), *inline]:
            if found.setdefault(view.id, view) != view:
                raise PlantError(f"View {view.id} is defined twice")
        return found


def find_view(graph: Graph, name: str, space: str | None = None, version: str | None = None) -> View:
    """The view of that name, space and version; what is left out must not matter."""
    if space is None and version is None and name in graph.views:
        return graph.views[name]
    found = [
        v for v in graph.known_views().values()
        if v.external_id == name and space in (None, v.space) and version in (None, v.version)
    ]
    if not found:
        raise PlantError(f"Could not find view {(space, name, version)}")
    if len(found) > 1:
        raise PlantError(f"Several views fit {(space, name, version)}: {sorted(v.id for v in found)}")
    return found[0]


def find_in_model(graph: Graph, model: tuple[str, str, str], name: str) -> View:
    """The view a data model means by a name: the model says which space and version."""
    models = [m for m in graph.models if (m.space, m.external_id, m.version) == model]
    if not models:
        raise PlantError(f"Could not find data model {model}")
    views = [v for m in models for v in m.views if v.external_id == name]
    if not views:
        raise PlantError(f"Could not find view {name} in data model {model}")
    first = views[0]
    return first if isinstance(first, View) else find_view(graph, first.external_id, first.space, first.version)


def find_connection(graph: Graph, model: tuple[str, str, str], view: str, name: str) -> Connection:
    found = [c for c in find_in_model(graph, model, view).connections if c.name == name]
    if not found:
        raise PlantError(f"Could not find connection {name} in view {view} of data model {model}")
    return found[0]


def property_table(graph: Graph, view: View) -> DataFrame:
    for key in (view.id, view.external_id):
        if key in graph.properties:
            return graph.properties[key]
    raise PlantError(f"View {view.id} has no table")


def _same(one: T.DataType, other: T.DataType) -> bool:
    return one.simpleString() == other.simpleString()


def _stored_type(prop: Property, schema: T.StructType) -> T.DataType | None:
    names = {n.lower(): n for n in schema.fieldNames()}
    return schema[names[prop.column.lower()]].dataType if prop.column.lower() in names else None


def _readable(stored: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _readable(stored.elementType, wanted.elementType)
    numbers = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if isinstance(wanted, T.StringType):
        return isinstance(stored, (T.StringType, T.DateType, T.TimestampType))
    return _same(stored, wanted) or isinstance(stored, numbers) and isinstance(wanted, numbers)


def read_columns(view: View, table: DataFrame) -> list[Column]:
    """The view's properties from its table, in the view's names and types; a property without a column is null.

    Numbers are read as any number type and times as text; other differences are errors.
    """
    columns = []
    for prop in view.properties:
        stored, wanted = _stored_type(prop, table.schema), prop.data_type()
        if stored is None:
            value = F.lit(None).cast(wanted)
        elif not _readable(stored, wanted):
            raise PlantError(f"'{prop.name}' of view {view.id} is stored as {stored.simpleString()}, not {wanted.simpleString()}")
        else:
            value = F.col(f"`{prop.column}`")
            value = value if _same(stored, wanted) else read_cast(value, stored, wanted)
        columns.append(value.alias(prop.name))
    return columns


def written_properties(view: View, source: DataFrame, table: DataFrame | None) -> list[Property]:
    """The properties a source sets, each of a kind whose values fit the view and the stored column alike.

    A write through a view whose numbers are not all numbers of the column's type, nor the other way round, is an
    error, as is a property that the table has no column for.
    """
    given = [p for p in view.properties if p.name in source.columns]
    columns = [p.column for p in given]
    if len(set(columns)) < len(columns):
        raise PlantError(f"view {view.id} writes a column twice: {sorted(c for c in set(columns) if columns.count(c) > 1)}")
    if table is None:
        return given
    kinds = {PROPERTY_TYPES[k].simpleString(): k for k in _NUMBERS}
    fitted = []
    for prop in given:
        stored = _stored_type(prop, table.schema)
        if stored is None:
            raise PlantError(f"the table of view {view.id} has no column for '{prop.name}'")
        if not _same(stored, prop.data_type()):
            one = stored.elementType if isinstance(stored, T.ArrayType) and prop.is_list else stored
            held = kinds.get(one.simpleString())
            if held is None or not {(prop.kind, held), (held, prop.kind)} & _WIDER:
                raise PlantError(f"'{prop.name}' can not be written through view {view.id}: it is stored as {stored.simpleString()}")
            prop = replace(prop, kind=prop.kind if (prop.kind, held) in _WIDER else held)
        fitted.append(prop)
    return fitted
