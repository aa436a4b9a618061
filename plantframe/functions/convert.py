"""Conversion and validation rules for written rows, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError

_NUMBERS = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
# Source types that a column of a given type takes.
_TAKES = {
    T.DoubleType: _NUMBERS,
    T.FloatType: _NUMBERS,
    T.LongType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.IntegerType,),
    T.BooleanType: (T.BooleanType,),
    T.StringType: (T.StringType,),
    T.TimestampType: (T.TimestampType,),
    T.DateType: (T.DateType,),
}


def clean_metadata(column: str | Column) -> Column:
    """A metadata map without null keys and null values."""
    return F.map_filter(column, lambda k, v: k.isNotNull() & v.isNotNull())


def normalise_labels(column: str | Column) -> Column:
    """Labels without nulls; an empty list counts as not set."""
    compact = F.array_compact(column)
    return F.when(F.size(compact) > 0, compact)


def coerce(value: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """``value`` as the target type, and whether it is refused. Null elements of arrays are dropped."""
    never = F.lit(False)
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target), never
    if isinstance(target, T.MapType):
        if not isinstance(source, T.MapType):
            return F.lit(None).cast(target), value.isNotNull()
        cleaned = clean_metadata(value)
        textual = isinstance(source.keyType, T.StringType) and isinstance(source.valueType, T.StringType)
        return (cleaned, never) if textual else (F.lit(None).cast(target), F.size(cleaned) > 0)
    if isinstance(target, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(target), value.isNotNull()
        compact = F.array_compact(value)
        if isinstance(target.elementType, T.StructType):
            return compact, never
        if not isinstance(source.elementType, _TAKES.get(type(target.elementType), ())):
            return F.lit(None).cast(target), F.size(compact) > 0
        return compact.cast(target), never
    if isinstance(target, T.StructType):
        return value, never
    if isinstance(source, _TAKES.get(type(target), ())):
        return value.cast(target), never
    return F.lit(None).cast(target), value.isNotNull()


def takes_all(source: T.DataType, target: T.DataType) -> bool:
    """Whether no value of the source type is refused by ``coerce``."""
    if isinstance(source, T.NullType) or source == target:
        return True
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return isinstance(target.elementType, T.StructType) or takes_all(source.elementType, target.elementType)
    return isinstance(target, T.StructType) or isinstance(source, _TAKES.get(type(target), ()))


def validate(
    df: DataFrame, schema: T.StructType, required: Sequence[str] = (), row_id: str = "externalId"
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows with the declared types, and errors (row, column, message).

    Columns that the schema does not know are ignored, columns that ``df`` lacks stay absent.
    """
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise PlantError(f"missing required properties: [{', '.join(absent)}]")
    name = F.col(row_id).cast("string") if row_id in df.columns else F.lit(None).cast("string")
    columns, problems = [], []
    for field in schema.fields:
        if field.name not in df.columns:
            continue
        source = df.schema[field.name].dataType
        value, bad = coerce(F.col(f"`{field.name}`"), source, field.dataType)
        columns.append(value.alias(field.name))
        text = F.col(f"`{field.name}`").cast("string") if isinstance(source, T.AtomicType) else F.to_json(
            F.struct(F.col(f"`{field.name}`"))
        )
        expected = f" in column {field.name}: expected {field.dataType.simpleString()}, got {source.simpleString()} "
        message = F.concat(F.lit("Row "), F.coalesce(name, F.lit("?")), F.lit(expected), text)
        problems.append((field.name, F.when(F.coalesce(bad, F.lit(False)), message)))
        if field.name in required:
            empty = F.concat(F.lit("Row "), F.coalesce(name, F.lit("?")), F.lit(f": '{field.name}' is null"))
            problems.append((field.name, F.when(F.col(f"`{field.name}`").isNull(), empty)))
    listed = F.filter(
        F.array(*[F.struct(F.lit(c).alias("column"), m.alias("error")) for c, m in problems]),
        lambda p: p["error"].isNotNull(),
    )
    judged = df.withColumn("_problems", listed)
    good = judged.filter(F.size("_problems") == 0).select(*columns)
    errors = judged.filter(F.size("_problems") > 0).select(name.alias("row"), F.explode("_problems").alias("_p"))
    return good, errors.select("row", "_p.column", "_p.error")


def _exact(value: Column) -> Column:
    return value.cast("string").try_cast("decimal(38,18)")


def narrow_exact(value: Column, target: T.DataType | str) -> tuple[Column, Column]:
    """A number as a narrower type, refused when that changes it (2.5 is no integer)."""
    narrowed = value.try_cast(target)
    same = _exact(narrowed).eqNullSafe(_exact(value)) & narrowed.isNotNull()
    return F.when(same, narrowed), value.isNotNull() & ~same


_INT_LOW = -(2**31)


def read_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """A property value in the type its column is read as."""
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: read_cast(x, source.elementType, target.elementType))
    if isinstance(target, T.StringType) and isinstance(source, T.TimestampType):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    if isinstance(target, T.IntegerType) and isinstance(source, T.LongType):
        # Keeps the low 32 bits.
        return (F.pmod(value - _INT_LOW, F.lit(2**32)) + _INT_LOW).cast("int")
    if isinstance(target, (T.IntegerType, T.LongType)) and isinstance(source, (T.FloatType, T.DoubleType)):
        # Truncates, and stops at the limits of the type; what is not a number is zero.
        bits = 31 if isinstance(target, T.IntegerType) else 63
        low, high = -(2**bits), 2**bits - 1
        whole = F.when(value >= float(high), F.lit(high)).when(value <= float(low), F.lit(low)).otherwise(value.try_cast(target))
        return F.when(F.isnan(value), F.lit(0)).otherwise(whole).cast(target)
    return value.cast(target)


_LOCAL = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"


def parse_timestamp(text: Column) -> Column:
    """ISO date-time with a zone, or without one as UTC; anything else is null."""
    zoned = F.when(text.rlike(rf"^{_LOCAL}(Z|[+-]\d{{2}}:\d{{2}})$"), text)
    local = F.when(text.rlike(rf"^{_LOCAL}$"), F.concat(text, F.lit("Z")))
    with_seconds = F.regexp_replace(F.coalesce(zoned, local), r"^(.{10}T\d{2}:\d{2})(Z|[+-])", "$1:00$2")
    return F.try_to_timestamp(with_seconds)


def parse_date(text: Column) -> Column:
    """ISO date, or the date of an ISO date-time as it is written; anything else is null."""
    plain = text.rlike(r"^\d{4}-\d{2}-\d{2}$") | parse_timestamp(text).isNotNull()
    return F.when(plain, F.substring(text, 1, 10)).try_cast("date")


def json_is_valid(text: str | Column) -> Column:
    """True when the text is one JSON value and nothing else.

    The parser stops after the first value, so the text is read inside a list and inside an object:
    left-over characters break at least one of them.
    """
    value = F.col(text) if isinstance(text, str) else text
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))), "$", "array<variant>")
    fields = F.try_parse_json(F.concat(F.lit('{"a":'), value, F.lit("}")))
    return F.coalesce((F.size(items) == 1) & fields.isNotNull(), F.lit(False))
