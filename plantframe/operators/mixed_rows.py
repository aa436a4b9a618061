"""Rows of many sequences in one frame: (externalId, rowNumber, values), where ``values`` is a variant object by column.

Each row is checked against the definition of its own sequence, which a join brings along as a map of types; cells are
looked at inside the row, so none of them travels alone. Refused rows are data, as in all writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Kinds of a variant that a column of a given type takes, before their precision.
_TAKES = {"STRING": ("STRING",), "DOUBLE": ("DOUBLE", "FLOAT", "DECIMAL", "BIGINT"), "LONG": ("BIGINT",)}


def _cells(values: str | Column) -> Column:
    return F.map_entries(F.col(values).cast("map<string, variant>") if isinstance(values, str) else values)


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _with_types(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """Rows with ``_types``, the value types of their sequence's columns by name; null for an unknown sequence."""
    pairs = F.map_from_entries(F.transform("columns", lambda c: F.struct(c["externalId"], c["valueType"])))
    return rows.join(sequences.select("externalId", pairs.alias("_types")), "externalId", "left")


def check_mixed_rows(rows: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the definition of their sequence, and (externalId, rowNumber, error) of the others.

    A null cell fits every column. All faults of a row are named, in the order of its columns.
    """

    def fault(cell: Column) -> Column:
        declared, kind = F.try_element_at("_types", cell["key"]), _kind(cell["value"])
        takes = F.lit(False)
        for value_type, kinds in _TAKES.items():
            takes = takes | ((declared == value_type) & kind.isin(*kinds))
        place = F.concat(F.lit("column "), cell["key"], F.lit(" of sequence "), F.col("externalId"))
        return (
            F.when(declared.isNull(), F.concat(place, F.lit(" does not exist")))
            .when((kind == "VOID") | takes, None)
            .otherwise(F.concat(place, F.lit(" has type "), kind, F.lit(", expected "), declared))
        )

    named = F.coalesce("externalId", F.lit("null"))
    cells = F.array_sort(F.array_compact(F.transform(_cells("values"), fault)))
    error = (
        F.when(F.col("_types").isNull(), F.concat(F.lit("unknown sequence "), named))
        .when(F.col("rowNumber").isNull(), F.concat(F.lit("a row of sequence "), named, F.lit(" has no rowNumber")))
        .when(F.size(cells) > 0, F.array_join(cells, "; "))
    )
    judged = _with_types(rows.select("externalId", "rowNumber", "values"), sequences).withColumn("error", error)
    return judged.filter("error is null").select("externalId", "rowNumber", "values"), judged.filter("error is not null").select("externalId", "rowNumber", "error")


def mixed_cells(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """Typed cells of rows that fit: externalId, rowNumber, column, valueType and its value as text, number or whole."""
    each = _with_types(rows, sequences).select("externalId", "rowNumber", "_types", F.explode(_cells("values")).alias("_c"))
    each = each.select("externalId", "rowNumber", F.col("_c.key").alias("column"), F.try_element_at("_types", F.col("_c.key")).alias("valueType"), F.col("_c.value").alias("_v"))
    typed = {name: F.when(F.col("valueType") == kind, F.col("_v").cast(data_type)) for kind, name, data_type in (("STRING", "text", "string"), ("DOUBLE", "number", "double"), ("LONG", "whole", "long"))}
    return each.select("externalId", "rowNumber", "column", "valueType", *[c.alias(n) for n, c in typed.items()])


def upsert_mixed_rows(target: DataFrame, source: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new table and the refused rows. By (sequence, rowNumber), cells that the source gives replace those there and
    the others stay; of several source rows for one, the greatest by its text counts."""
    good, errors = check_mixed_rows(source, sequences)
    keys = ["externalId", "rowNumber"]
    fresh = good.withColumn("_text", F.to_json("values")).groupBy(*keys).agg(F.max("_text").alias("_text"))
    fresh = cut_lineage(fresh).withColumn("_new", F.parse_json("_text").cast("map<string, variant>")).drop("_text")
    joined = target.join(fresh, keys, "full")
    old = F.coalesce(F.col("values").cast("map<string, variant>"), F.create_map().cast("map<string, variant>"))
    given = F.map_keys("_new")
    both = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(given, k)), F.col("_new"))
    merged = F.when(F.col("_new").isNull(), F.col("values")).otherwise(F.to_variant_object(both))
    return joined.select(*keys, merged.alias("values")), errors
