"""Tables of JSON objects: inferring, typing, renaming and writing them."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..operators.skew import keep_greatest
from ..session import cut_lineage

# Rows read to infer a schema, and the column names that rows carry by themselves.
LONG_LIST = 10_000
RESERVED = (re.compile(r"_*key"), re.compile(r"_*lastUpdatedTime"))


def _is_reserved(name: str) -> bool:
    return any(p.fullmatch(name) for p in RESERVED)


def to_column_name(json_name: str) -> str:
    """A JSON field that looks like a row's own column gets one more underscore."""
    return f"_{json_name}" if _is_reserved(json_name) else json_name


def to_json_name(column: str) -> str:
    """The JSON field of a column: undoes ``to_column_name``."""
    return column[1:] if _is_reserved(column) and column.startswith("_") else column


def rename_reserved(df: DataFrame) -> DataFrame:
    """Rename all columns at once, so that no rename meets the result of another."""
    return df.toDF(*[to_column_name(c) for c in df.columns])


def unrename_reserved(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_json_name(c) for c in df.columns])


_DECIMAL = re.compile(r"DECIMAL\((\d+),\s*(\d+)\)")


def _spark_type(variant_schema: str) -> T.DataType:
    """The type for a merged variant schema: fractions are doubles, conflicts and nulls are strings."""

    def number(found: re.Match) -> str:
        precision, scale = int(found[1]), int(found[2])
        return found[0] if scale == 0 and precision > 18 else "DOUBLE"

    ddl = re.sub(r"(?<=: )(VOID|VARIANT)\b|(?<=ARRAY<)(VOID|VARIANT)\b", "STRING", variant_schema)
    ddl = re.sub(r"(?<=: )OBJECT<|(?<=ARRAY<)OBJECT<|^OBJECT<", "STRUCT<", ddl)
    return T.DataType.fromDDL(_DECIMAL.sub(number, ddl))


def infer_json_schema(df: DataFrame, column: str = "columns", limit: int | None = None) -> T.StructType:
    """Schema of the JSON objects in a text column, from all rows or at most ``limit``, fields by name."""
    sample = df.select(column) if limit is None else df.select(column).limit(limit)
    merged = sample.agg(F.schema_of_variant_agg(F.parse_json(column)).alias("s")).first()["s"]
    if not merged or not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return T.StructType([])
    return _spark_type(merged)


def _is_number(kind: Column) -> Column:
    return kind.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


_INTEGERS = {
    T.ByteType: (-(2**7), 2**7 - 1),
    T.ShortType: (-(2**15), 2**15 - 1),
    T.IntegerType: (-(2**31), 2**31 - 1),
    T.LongType: (-(2**63), 2**63 - 1),
}


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _result(value: Column, bad: Column) -> Column:
    return F.struct(value.alias("value"), F.coalesce(bad, F.lit(False)).alias("bad"))


def _scalar(kind: Column, text: Column, data_type: T.DataType) -> Column:
    """A JSON scalar, given its kind and its text, as ``data_type``, and whether it has the wrong shape."""
    is_null = _is_null(kind)
    is_text, is_number = kind == "STRING", _is_number(kind)

    def checked(found: Column, accepted: Column, empty_is_null: bool = True) -> Column:
        skipped = is_null | (is_text & (text == "")) if empty_is_null else is_null
        good = F.when(~skipped & accepted, found)
        return _result(good, ~skipped & good.isNull())

    if isinstance(data_type, T.NullType):
        return _result(F.lit(None), F.lit(False))
    if isinstance(data_type, T.StringType):
        return _result(F.when(~is_null, text), F.lit(False))
    if isinstance(data_type, T.BooleanType):
        is_flag = kind == "BOOLEAN"
        return checked(F.lower(text) == "true", is_flag | is_text)
    if type(data_type) in _INTEGERS:
        low, high = _INTEGERS[type(data_type)]
        exact, near = text.try_cast("decimal(38,10)"), text.try_cast("double")
        # A decimal cast rounds, so that nothing is left behind the point is seen in the text, or in the double it shows.
        no_rest = F.when(text.contains("E"), near == F.floor(near)).otherwise(text.rlike(r"^-?[0-9]+([.]0*)?$"))
        whole = is_number & no_rest & exact.between(F.lit(low), F.lit(high))
        digits = is_text & text.rlike(r"^[+-]?[0-9]+$")
        return checked(F.when(is_number, exact.try_cast(data_type)).otherwise(text.try_cast(data_type)), whole | digits)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return checked(F.trim(text).try_cast(data_type), is_number | is_text)
    if isinstance(data_type, T.DecimalType):
        return checked(text.try_cast(data_type), is_number | is_text, empty_is_null=False)
    if isinstance(data_type, T.BinaryType):
        return checked(F.try_to_binary(text, F.lit("base64")), is_text, empty_is_null=False)
    raise PlantError(f"JSON can not be read as {data_type.typeName()}")


def json_value(value: Column, data_type: T.DataType) -> Column:
    """A variant as ``struct<value, bad>``: the value as ``data_type``, and whether it has the wrong shape.

    Numbers accept JSON numbers and numeric text, booleans accept true, false and text, text accepts
    anything as JSON. Empty text is null for numbers and booleans.
    """

    if _is_text(data_type):
        # Text takes anything, so the shape is all there is to check.
        found = F.try_variant_get(value, "$", data_type.simpleString())
        return _bind(found, lambda x: _result(x, x.isNull() & ~_is_null(F.schema_of_variant(value))))

    def nested(is_kind: Column, is_null: Column, made: Column, inner: Column) -> Column:
        return _result(F.when(is_kind, made), ~is_null & (~is_kind | inner))

    if isinstance(data_type, T.StructType):

        def as_struct(x: Column) -> Column:
            made = F.struct(*[x["parts"].getField(f.name)["value"].alias(f.name) for f in data_type.fields])
            inner = reduce(Column.__or__, [x["parts"].getField(f.name)["bad"] for f in data_type.fields], F.lit(False))
            return nested(x["kind"].startswith("OBJECT"), _is_null(x["kind"]), made, inner)

        parts = F.struct(*[json_value(_field(value, f.name), f.dataType).alias(f.name) for f in data_type.fields])
        return _bind(F.struct(F.schema_of_variant(value).alias("kind"), parts.alias("parts")), as_struct)
    if isinstance(data_type, T.ArrayType):

        def as_array(x: Column) -> Column:
            made = F.transform(x["parts"], lambda p: p["value"])
            inner = F.exists(x["parts"], lambda p: p["bad"])
            return nested(x["kind"].startswith("ARRAY"), _is_null(x["kind"]), made, inner)

        items = F.try_variant_get(value, "$", "array<variant>")
        parts = F.transform(items, lambda i: json_value(i, data_type.elementType))
        return _bind(F.struct(F.schema_of_variant(value).alias("kind"), parts.alias("parts")), as_array)
    if isinstance(data_type, T.MapType):

        def as_map(x: Column) -> Column:
            made = F.transform_values(x["parts"], lambda _, p: p["value"])
            inner = F.exists(F.map_values(x["parts"]), lambda p: p["bad"])
            return nested(x["kind"].startswith("OBJECT"), _is_null(x["kind"]), made, inner)

        items = F.try_variant_get(value, "$", "map<string,variant>")
        parts = F.transform_values(items, lambda _, i: json_value(i, data_type.valueType))
        return _bind(F.struct(F.schema_of_variant(value).alias("kind"), parts.alias("parts")), as_map)
    text = F.try_variant_get(value, "$", "string")
    known = F.struct(F.schema_of_variant(value).alias("kind"), text.alias("text"))
    return _bind(known, lambda x: _scalar(x["kind"], x["text"], data_type))


def _is_text(data_type: T.DataType) -> bool:
    """True for text, and for arrays and maps that hold nothing but text."""
    if isinstance(data_type, T.ArrayType):
        return _is_text(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _is_text(data_type.valueType)
    return isinstance(data_type, T.StringType)


def _has_parts(kind: Column) -> Column:
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _is_null(kind: Column) -> Column:
    return kind.isNull() | (kind == "VOID")


@dataclass(frozen=True)
class _Node:
    """A field of the schema, or of a struct inside it; arrays and maps are leaves."""

    index: int
    parent: int | None
    depth: int
    name: str
    data_type: T.DataType

    @property
    def is_text(self) -> bool:
        return isinstance(self.data_type, T.StringType)


def _nodes(schema: T.StructType) -> list[_Node]:
    nodes: list[_Node] = []

    def visit(fields: Sequence[T.StructField], parent: int | None, depth: int) -> None:
        for f in fields:
            node = _Node(len(nodes), parent, depth, f.name, f.dataType)
            nodes.append(node)
            if isinstance(f.dataType, T.StructType):
                visit(f.dataType.fields, node.index, depth + 1)

    visit(schema.fields, None, 0)
    return nodes


def _field(value: Column, name: str, kind: str = "variant") -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", kind)


def _if_set(column: str, use: Column) -> Column:
    """``use``, a JSON or map function of ``column`` that gives null for null.

    Spark evaluates the arguments of such functions node by node, without compiling them. As the test for null reads the
    column a second time, an expression that makes its text stays in a projection of its own, which is compiled.
    """
    return F.when(F.col(column).isNotNull(), use)


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))


def read_json_table(
    df: DataFrame, schema: T.StructType, on_error: str = "column", column: str = "columns",
    sources: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed rows of a JSON table: key, lastUpdatedTime, then one column per field of ``schema``.

    Rows with a value of the wrong shape keep the good values and list the bad ones in ``_errors``, where
    rows that are no JSON say so and have no values; or they fail the job with ``on_error='raise'``. Each step is a projection of its own, so that a parsed
    value is computed once however often it is used. ``sources`` names the JSON field of a field that is called
    otherwise in ``schema``, so that one field can be read as several types at once.
    """
    if on_error not in ("column", "raise"):
        raise PlantError("on_error must be column or raise")
    nodes = _nodes(schema)
    top = [n for n in nodes if n.parent is None]
    origin = {n.index: (sources or {}).get(n.name, n.name) for n in top}
    as_text = {name: all(n.is_text for n in top if origin[n.index] == name) for name in origin.values()}
    wanted = T.StructType([T.StructField(name, T.StringType() if plain else T.VariantType()) for name, plain in as_text.items()])
    options, broken = {"mode": "FAILFAST"}, F.lit(False)
    if on_error == "column":
        # The text of a malformed row goes to a field whose name no other field has.
        rest = "_malformed" + "_" * max((len(name) for name in as_text), default=0)
        wanted = T.StructType([*wanted.fields, T.StructField(rest, T.StringType())])
        options, broken = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rest}, F.col("_t").getField(rest).isNotNull()

    def taken(n: _Node) -> Column:
        found = F.col("_t").getField(origin[n.index])
        return F.try_variant_get(found, "$", "string") if n.is_text and not as_text[origin[n.index]] else found

    parsed = df.select("key", "lastUpdatedTime", _if_set(column, F.from_json(column, wanted, options)).alias("_t"))
    work = parsed.select(
        "key",
        "lastUpdatedTime",
        broken.alias("_broken"),
        *[F.when(~broken, taken(n)).alias(f"_f{n.index}") for n in top],
    )
    for depth in range(1, max((n.depth for n in nodes), default=0) + 1):
        inner = [n for n in nodes if n.depth == depth]
        work = work.select(
            "*",
            *[
                _field(F.col(f"_f{n.parent}"), n.name, "string" if n.is_text else "variant").alias(f"_f{n.index}")
                for n in inner
            ],
        )
    scalars = [n for n in nodes if not n.is_text and not _is_nested(n.data_type)]
    structs = [n for n in nodes if isinstance(n.data_type, T.StructType)]
    leaves = [n for n in nodes if not isinstance(n.data_type, T.StructType)]
    # A JSON field that is read as several scalar types has its kind and its text taken once.
    read = {n.index: next(m.index for m in scalars if m is n or n.parent is m.parent is None and origin[m.index] == origin[n.index]) for n in scalars}
    once = sorted({*read.values()})
    known = work.select(
        "*",
        *[F.schema_of_variant(f"_f{i}").alias(f"_k{i}") for i in [*once, *[n.index for n in structs]]],
        # Objects and arrays are never scalars, and writing them as text is slow.
        *[F.when(~_has_parts(F.schema_of_variant(f"_f{i}")), F.try_variant_get(f"_f{i}", "$", "string")).alias(f"_x{i}") for i in once],
    )

    def result(n: _Node) -> Column:
        if n.is_text:
            return _result(F.col(f"_f{n.index}"), F.lit(False))
        if _is_nested(n.data_type):
            return json_value(F.col(f"_f{n.index}"), n.data_type)
        return _scalar(F.col(f"_k{read[n.index]}"), F.col(f"_x{read[n.index]}"), n.data_type)

    judged = known.select(
        "key",
        "lastUpdatedTime",
        "_broken",
        *[f"_k{n.index}" for n in structs],
        *[result(n).alias(f"_r{n.index}") for n in leaves],
    )

    def assembled(n: _Node) -> tuple[Column, Column]:
        if not isinstance(n.data_type, T.StructType):
            return F.col(f"_r{n.index}.value"), F.col(f"_r{n.index}.bad")
        kind = F.col(f"_k{n.index}")
        children = {c.name: assembled(c) for c in nodes if c.parent == n.index}
        is_object = kind.startswith("OBJECT")
        made = F.struct(*[value.alias(name) for name, (value, _) in children.items()])
        inner = reduce(Column.__or__, [bad for _, bad in children.values()], F.lit(False))
        return F.when(is_object, made), F.coalesce(~_is_null(kind) & (~is_object | inner), F.lit(False))

    def message(name: str) -> Column:
        return F.concat(F.lit("row "), "key", F.lit(f": wrong type in column {name}"))

    found = {n.name: assembled(n) for n in top}
    columns = ["key", "lastUpdatedTime"]
    for n in top:
        value, bad = found[n.name]
        value = value.cast(n.data_type)
        if on_error == "raise":
            # Each column raises for itself, so a filter on one column does not drag the others along.
            value = F.when(bad, F.raise_error(message(n.name)).cast(n.data_type)).otherwise(value)
        columns.append(value.alias(to_column_name(n.name)))
    if on_error == "column":
        problems = [F.when(bad, message(name)) for name, (_, bad) in found.items()]
        problems.append(F.when(F.col("_broken"), F.concat(F.lit("row "), "key", F.lit(": malformed JSON"))))
        errors = F.array_compact(F.array(*problems))
        columns.append(errors.cast("array<string>").alias("_errors"))
    return judged.select(*columns)


def drop_null_fields(column: str = "columns") -> Column:
    """JSON objects without their null fields."""
    fields = F.try_variant_get(F.parse_json(column), "$", "map<string,variant>")
    return _if_set(column, F.to_json(F.map_filter(fields, lambda _, v: ~F.is_variant_null(v))))


def _writable(value: Column, data_type: T.DataType) -> Column:
    """A value in the form it has in JSON: times as text, map keys as text."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = value.cast("string")
        return F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0")))
    if isinstance(data_type, T.DateType):
        return value.cast("string")
    if isinstance(data_type, T.BinaryType):
        raise PlantError(
            "binary columns can not be stored as JSON, write them as base64 text"
        )
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: _writable(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: k.cast("string"))
        return F.transform_values(keyed, lambda _, v: _writable(v, data_type.valueType))
    if isinstance(data_type, T.StructType):
        made = F.struct(*[_writable(value.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields])
        return F.when(value.isNotNull(), made)
    return value


def to_json_table(df: DataFrame, ignore_null_fields: bool = False) -> DataFrame:
    """Rows as (key, columns): every other column becomes a JSON field; lastUpdatedTime is dropped.

    A null key fails the job.
    """
    if "key" not in df.columns:
        raise PlantError("rows of a JSON table need a column named key")
    fields = [f for f in df.schema.fields if f.name not in ("key", "lastUpdatedTime")]
    made = F.struct(*[_writable(F.col(f"`{f.name}`"), f.dataType).alias(to_json_name(f.name)) for f in fields])
    key = F.coalesce(F.col("key").cast("string"), F.raise_error(F.lit("a row of a JSON table has a null key")))
    options = {"ignoreNullFields": str(ignore_null_fields).lower()}
    return df.select(key.alias("key"), (F.to_json(made, options) if fields else F.lit("{}")).alias("columns"))


def select_keys(df: DataFrame, keys: Sequence[str], limit: int = LONG_LIST) -> DataFrame:
    """Rows with one of ``keys``; nulls in the list match nothing. Long lists travel as a table."""
    wanted = sorted({k for k in keys if k is not None})
    if len(wanted) <= limit:
        return df.filter(F.col("key").isin(wanted)) if wanted else df.filter(F.lit(False))
    listed = df.sparkSession.createDataFrame([(k,) for k in wanted], "key string")
    return df.join(listed, "key", "left_semi")


def insert_rows(target: DataFrame, source: DataFrame, now: Column | None = None) -> DataFrame:
    """Write rows into a JSON table: rows with the same key are replaced."""
    stamped = keep_greatest(to_json_table(source), ["key"]).withColumn(
        "lastUpdatedTime", F.current_timestamp() if now is None else now
    )
    fresh = cut_lineage(stamped)
    return target.join(fresh.select("key"), "key", "left_anti").unionByName(fresh.select(*target.columns))
