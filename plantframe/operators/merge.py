"""Insert, update, upsert and delete as table transformations.

``merge`` never changes data in place: it returns the new table, what changed, and the rows it refuses.
Source rows are first resolved to target ids, so the wide table is joined once, on a key without nulls.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import PlantError
from ..functions.convert import coerce, normalise_labels, takes_all
from ..session import cut_lineage
from ..sources.schemas import WRITE_RULES, WriteRules
from .skew import dense_rank_ids, keep_greatest

ERROR_SCHEMA = "id long, externalId string, error string"


@dataclass
class MergeResult:
    """``table`` is the new table; it is valid when ``errors`` is empty."""

    table: DataFrame
    created: DataFrame
    updated: DataFrame
    deleted: DataFrame
    errors: DataFrame
    read: DataFrame

    def counts(self) -> DataFrame:
        """One row per outcome with its number of rows."""
        parts = {
            "read": self.read,
            "created": self.created,
            "updated": self.updated,
            "deleted": self.deleted,
            "errors": self.errors,
        }
        counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("outcome"), "n") for k, df in parts.items()]
        return reduce(DataFrame.unionByName, counted)

    def raise_for_errors(self) -> MergeResult:
        found = [r["error"] for r in self.errors.limit(10).collect()]
        if found:
            raise PlantError("; ".join(found))
        return self


def _errors(rows: DataFrame, message: Column | str) -> DataFrame:
    """Refused rows in one shape, whatever columns they came with."""
    text = F.lit(message) if isinstance(message, str) else message
    has = rows.columns
    return rows.select(
        (F.col("id").cast("long") if "id" in has else F.lit(None).cast("long")).alias("id"),
        (F.col("externalId") if "externalId" in has else F.lit(None).cast("string")).alias("externalId"),
        text.alias("error"),
    )


def merge(
    target: DataFrame,
    source: DataFrame,
    resource: str,
    mode: str = "abort",
    *,
    ignore_null_fields: bool = True,
    ignore_unknown_ids: bool = True,
    order_by: str | None = None,
    now: datetime | None = None,
    highest_id: int | None = None,
) -> MergeResult:
    """Write ``source`` into ``target`` by the rules of ``resource``.

    Among source rows for one item, the greatest by ``order_by`` wins, then the greatest row. New ids follow
    ``highest_id``, or the highest one of ``target`` when that is the whole table.
    """
    rules = WRITE_RULES.get(resource)
    if rules is None:
        raise PlantError(f"Resource {resource} can not be written with merge")
    mode = mode.lower()
    if mode not in rules.modes:
        raise PlantError(f"Mode {mode} is not supported for {resource}")
    stamp = F.current_timestamp() if now is None else F.lit(now)
    order = [F.col(order_by)] if order_by else []
    if mode == "insert_into":
        return merge(
            target, source.drop("id"), resource, "upsert",
            ignore_null_fields=ignore_null_fields, order_by=order_by, now=now, highest_id=highest_id,
        )
    if mode == "delete":
        return _delete(target, source, rules, ignore_unknown_ids)
    good, refused = _tidied(source, target)
    work = _Merge(target, good, rules, ignore_null_fields, order, stamp)
    work.highest_id = highest_id
    if mode == "abort":
        result = work.insert()
    else:
        result = work.update() if mode == "update" else work.upsert()
    return replace(result, errors=result.errors if refused is None else result.errors.unionByName(refused), read=source)


def _tidied(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their values as they are stored, and errors for rows with a value of a type that its column does not take.

    Numbers become those of the column; arrays and maps lose their nulls, and an empty list of labels or sequence
    columns is not given. Columns that the target does not have stay as they are.
    """
    name = F.concat(F.lit("Row "), F.coalesce(*[F.col(c).cast("string") for c in ("externalId", "id") if c in source.columns], F.lit("?")))
    values, problems = [], []
    for field in source.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in target.columns:
            wanted = target.schema[field.name].dataType
            text = value.cast("string") if isinstance(field.dataType, T.AtomicType) else F.to_json(F.struct(value))
            value, bad = coerce(value, field.dataType, wanted)
            if not takes_all(field.dataType, wanted):
                what = f" in column {field.name}: expected {wanted.simpleString()}, got {field.dataType.simpleString()} "
                problems.append(F.when(F.coalesce(bad, F.lit(False)), F.concat(name, F.lit(what), text)))
            if field.name in ("labels", "columns") and isinstance(wanted, T.ArrayType):
                value = normalise_labels(value)
        values.append(value.alias(field.name))
    if not problems:
        return source.select(*values), None
    message = F.concat_ws("; ", *problems)
    return source.filter(message == "").select(*values), _errors(source.filter(message != ""), message)


def _changed_columns(new: Column, old: Column, data_type: T.ArrayType) -> Column:
    """The columns that an update of a sequence lists: those there already keep the fields that it leaves open, others
    are added, as text unless it says otherwise, and those it does not list go."""

    def merged(column: Column) -> Column:
        before = F.try_element_at(F.filter(old, lambda o: o["externalId"] == column["externalId"]), F.lit(1))
        fields = []
        for f in data_type.elementType.fields:
            given = [column[f.name], before[f.name], *([F.lit("STRING")] if f.name == "valueType" else [])]
            fields.append(F.coalesce(*given).alias(f.name))
        return F.struct(*fields)

    return F.transform(new, merged)


class _Merge:
    def __init__(
        self,
        target: DataFrame,
        source: DataFrame,
        rules: WriteRules,
        ignore_null_fields: bool,
        order: list[Column],
        stamp: Column,
    ):
        self.target, self.source, self.rules = target, source, rules
        self.ignore_null_fields, self.order, self.stamp = ignore_null_fields, order, stamp
        self.key = "id" if rules.has_id else "externalId"
        self.highest_id: int | None = None
        if "id" not in source.columns and "externalId" not in source.columns and not rules.has_id:
            raise PlantError("externalId is required")
        self.fields = [
            c for c in source.columns if c in target.columns and c not in ("id", "createdTime", "lastUpdatedTime")
        ]

    def _positive_id(self) -> Column:
        if self.rules.has_id and "id" in self.source.columns:
            return F.coalesce(F.col("id") > 0, F.lit(False))
        return F.lit(False)

    def _name(self) -> Column:
        return F.col("externalId") if "externalId" in self.source.columns else F.lit(None).cast("string")

    def _known(self) -> DataFrame:
        """External ids of the target with the key they stand for."""
        named = self.target.filter(F.col("externalId").isNotNull())
        return named.select("externalId", F.col(self.key).alias("_key"))

    def _resolve(self, rows: DataFrame) -> DataFrame:
        """One row per named item with ``_by`` (id or name) and ``_key``, the target row or null.

        The cleaned source and the keys it meets are written once each: they are read for updates,
        creates and errors, and with their sizes known a small source leaves the target unshuffled.
        """
        parts = []
        if self.rules.has_id and "id" in rows.columns:
            one = keep_greatest(rows.filter(self._positive_id()), ["id"], self.order)
            parts.append(one.withColumn("_by", F.lit("id")))
        if "externalId" in rows.columns:
            named = rows.filter(~self._positive_id() & F.col("externalId").isNotNull())
            parts.append(keep_greatest(named, ["externalId"], self.order).withColumn("_by", F.lit("name")))
        named_by = F.when(F.col("_by") == "id", self._id_text()).otherwise(self._name())
        clean = cut_lineage(reduce(DataFrame.unionByName, parts).withColumn("_named", named_by))
        met = []
        if self.rules.has_id and "id" in rows.columns:
            ids = self.target.select("id").join(clean.filter("_by = 'id'").select("id"), "id", "left_semi")
            met.append(ids.select(F.lit("id").alias("_by"), F.col("id").cast("string").alias("_named"), F.col("id").alias("_key")))
        if "externalId" in rows.columns:
            names = self._known().join(clean.filter("_by = 'name'").select("externalId"), "externalId", "left_semi")
            met.append(names.select(F.lit("name").alias("_by"), F.col("externalId").alias("_named"), "_key"))
        keys = cut_lineage(reduce(DataFrame.unionByName, met))
        return clean.join(keys, ["_by", "_named"], "left").drop("_named")

    def _unknown(self, resolved: DataFrame) -> DataFrame:
        message = F.when(F.col("_by") == "id", F.concat(F.lit("unknown id "), self._id_text())).otherwise(
            F.concat(F.lit("unknown externalId "), self._name())
        )
        return _errors(resolved.filter("_key is null"), message)

    def _id_text(self) -> Column:
        return F.col("id").cast("string") if "id" in self.source.columns else F.lit(None).cast("string")

    def _updates(self, resolved: DataFrame) -> DataFrame:
        """One update per target row; an update by id wins over one by external id."""
        known = resolved.filter("_key is not null")
        if not (self.rules.has_id and "id" in self.source.columns and "externalId" in self.source.columns):
            return cut_lineage(known)
        return cut_lineage(keep_greatest(known, ["_key"], [(F.col("_by") == "id").cast("int")]))

    def _changed_types(self, updates: DataFrame) -> list[DataFrame]:
        """Errors for updates that would give a sequence column another value type."""
        if "columns" not in self.fields:
            return []
        old = self.target.select(F.col(self.key).alias("_key"), F.col("columns").alias("_old"))
        other = F.expr("exists(columns, c -> exists(_old, o -> o.externalId = c.externalId and o.valueType <> c.valueType))")
        return [_errors(updates.join(old, "_key").filter(other), "the value type of a sequence column can not change")]

    def _is_empty_update(self) -> Column:
        if not self.ignore_null_fields:
            return F.lit(False)
        empty = F.lit(True)
        for c in self.fields:
            if c != "externalId":
                empty = empty & F.col(c).isNull()
        return empty

    def _apply(self, updates: DataFrame) -> DataFrame:
        """The target with the updates written over it: absent columns and ignored nulls stay."""
        fresh = updates.select("_key", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in self.fields])
        joined = self.target.join(fresh, F.col(self.key) == F.col("_key"), "left")

        def field(name: str) -> Column:
            old = F.col(f"`{name}`")
            if name == "lastUpdatedTime":
                return F.when(F.col("_hit"), self.stamp).otherwise(old).alias(name)
            if name not in self.fields:
                return old
            new = F.col(f"_new_{name}").cast(self.target.schema[name].dataType)
            if name == "columns":
                new = _changed_columns(new, old, self.target.schema[name].dataType)
            if not self.ignore_null_fields and name in self.rules.clearable:
                return F.when(F.col("_hit"), new).otherwise(old).alias(name)
            return F.coalesce(new, old).alias(name)

        return joined.select(*[field(c) for c in self.target.columns])

    def _create(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """New target rows, and errors for rows that lack a required field."""
        lacking = [
            F.when(F.col(c).isNull() if c in rows.columns else F.lit(True), F.lit(f"{c} is missing on a new item"))
            for c in self.rules.required
        ]
        message = F.concat_ws("; ", *lacking) if lacking else F.lit("")
        good = rows.filter(message == "")
        defaults = dict(self.rules.defaults)
        types = {f.name: f.dataType for f in self.target.schema.fields}
        if self.rules.has_id and "id" in types:
            unique = F.coalesce(F.concat(F.lit("e"), self._name()), F.concat(F.lit("r"), F.to_json(F.struct(*self.fields))))
            good = dense_rank_ids(good, unique, "_rank")
            highest = F.lit(self.highest_id)
            if self.highest_id is None:
                highest = self.target.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()

        def field(name: str) -> Column:
            if name == "id":
                return (highest + 1 + F.col("_rank")).cast("long").alias("id")
            if name in ("createdTime", "lastUpdatedTime"):
                return self.stamp.cast(types[name]).alias(name)
            value = F.col(name) if name in self.fields else F.lit(None)
            if name in defaults:
                value = F.coalesce(value, F.lit(defaults[name]))
            return value.cast(types[name]).alias(name)

        return good.select(*[field(c) for c in self.target.columns]), _errors(rows.filter(message != ""), message)

    def _result(self, creates: DataFrame | None, updates: DataFrame | None, errors: list[DataFrame]) -> MergeResult:
        table = self.target if updates is None else self._apply(updates)
        none = self.target.limit(0)
        if creates is not None:
            table = table.unionByName(creates)
        touched = none
        if updates is not None:
            touched = self.target.join(updates.select(F.col("_key").alias(self.key)), self.key, "left_semi")
        return MergeResult(
            table,
            creates if creates is not None else none,
            touched,
            none,
            reduce(DataFrame.unionByName, errors),
            self.source,
        )

    def insert(self) -> MergeResult:
        created, errors = self._create(self.source)
        problems = [errors]
        if "externalId" in self.source.columns:
            named = self.source.filter(F.col("externalId").isNotNull())
            repeated = named.groupBy("externalId").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            taken = named.join(self._known().select("externalId"), "externalId", "left_semi")
            problems.append(_errors(taken, F.concat(F.lit("externalId already exists: "), F.col("externalId"))))
            problems.append(_errors(repeated, F.concat(F.lit("externalId occurs several times: "), F.col("externalId"))))
        return self._result(created, None, problems)

    def update(self) -> MergeResult:
        nameless = self.source.filter(~self._positive_id() & self._name().isNull())
        resolved = self._resolve(self.source.filter(~self._is_empty_update()))
        problems = [
            _errors(nameless, "an update needs an id or externalId"),
            self._unknown(resolved),
        ]
        updates = self._updates(resolved)
        return self._result(None, updates, problems + self._changed_types(updates))

    def upsert(self) -> MergeResult:
        resolved = self._resolve(self.source)
        nameless = self.source.filter(~self._positive_id() & self._name().isNull())
        only = self.rules.update_only_without
        only_update = F.lit(False)
        if only:
            only_update = F.col(only).isNull() if only in self.source.columns else F.lit(True)
        new = F.col("_key").isNull() & (F.col("_by") == "name") & ~only_update
        created, errors = self._create(resolved.filter(new).drop("_key", "_by").unionByName(nameless))
        updates = self._updates(resolved)
        return self._result(created, updates, [self._unknown(resolved.filter(~new)), errors, *self._changed_types(updates)])


def _delete(target: DataFrame, source: DataFrame, rules: WriteRules, ignore_unknown_ids: bool) -> MergeResult:
    by_id = "id" in rules.delete_by and "id" in source.columns
    by_name = "externalId" in rules.delete_by and "externalId" in source.columns
    if not by_id and not by_name:
        raise PlantError(f"a delete needs one of the columns {', '.join(rules.delete_by)}")
    key = "id" if rules.has_id else "externalId"
    found, unknown, problems = [], [], []
    positive = F.col("id").isNotNull() if by_id else F.lit(False)
    if by_id:
        wanted = cut_lineage(source.filter(positive).select("id").distinct())
        present = target.select("id").join(wanted, "id", "left_semi")
        found.append(present.select(F.col("id").alias("_key")))
        missing = wanted.join(present, "id", "left_anti")
        unknown.append(_errors(missing, F.concat(F.lit("unknown id "), F.col("id").cast("string"))))
    if by_name:
        wanted = cut_lineage(source.filter(~positive & F.col("externalId").isNotNull()).select("externalId").distinct())
        named = target.filter(F.col("externalId").isNotNull()).select("externalId", F.col(key).alias("_key"))
        present = named.join(wanted, "externalId", "left_semi")
        found.append(present.select("_key"))
        missing = wanted.join(present, "externalId", "left_anti")
        unknown.append(_errors(missing, F.concat(F.lit("unknown externalId "), F.col("externalId"))))
    keyless = source.filter(~positive & (F.col("externalId").isNull() if by_name else F.lit(True)))
    problems.append(_errors(keyless, f"a delete needs {' or '.join(rules.delete_by)}"))
    if not (ignore_unknown_ids and rules.may_ignore_unknown):
        problems += unknown
    keys = cut_lineage(reduce(DataFrame.unionByName, found).distinct().select(F.col("_key").alias(key)))
    return MergeResult(
        target.join(keys, key, "left_anti"),
        target.limit(0),
        target.limit(0),
        target.join(keys, key, "left_semi"),
        reduce(DataFrame.unionByName, problems),
        source,
    )
