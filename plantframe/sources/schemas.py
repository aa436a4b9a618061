"""Columns of the resource tables, and the rules for writing each of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


# Names and types of the columns that a scan returns.
READ_SCHEMAS = {
    "assets": (
        "externalId string, name string, parentId long, parentExternalId string, description string, "
        "metadata map<string,string>, source string, id long, createdTime timestamp, "
        "lastUpdatedTime timestamp, rootId long, "
        "aggregates struct<childCount:long,path:array<string>,depth:long>, dataSetId long, labels array<string>"
    ),
    "events": (
        "id long, startTime timestamp, endTime timestamp, description string, type string, subtype string, "
        "metadata map<string,string>, assetIds array<long>, source string, externalId string, "
        "createdTime timestamp, lastUpdatedTime timestamp, dataSetId long"
    ),
    "timeseries": (
        "name string, isString boolean, metadata map<string,string>, unit string, assetId long, isStep boolean, "
        "description string, securityCategories array<long>, id long, externalId string, createdTime timestamp, "
        "lastUpdatedTime timestamp, dataSetId long, unitExternalId string"
    ),
    "datapoints": ("id long, externalId string, timestamp timestamp, value double"),
    "stringdatapoints": ("id long, externalId string, timestamp timestamp, value string"),
    "files": (
        "id long, name string, source string, directory string, externalId string, mimeType string, "
        "metadata map<string,string>, assetIds array<long>, uploaded boolean, uploadedTime timestamp, "
        "createdTime timestamp, lastUpdatedTime timestamp, labels array<string>, sourceCreatedTime timestamp, "
        "sourceModifiedTime timestamp, securityCategories array<long>, uploadUrl string, dataSetId long"
    ),
    "sequences": (
        "id long, name string, description string, assetId long, externalId string, metadata map<string,string>, "
        "columns array<struct<externalId:string,name:string,description:string,valueType:string>>, "
        "createdTime timestamp, lastUpdatedTime timestamp, dataSetId long"
    ),
    "labels": ("externalId string, name string, description string, createdTime timestamp, dataSetId long"),
    "relationships": (
        "externalId string, sourceExternalId string, sourceType string, targetExternalId string, targetType string, "
        "startTime timestamp, endTime timestamp, confidence double, labels array<string>, createdTime timestamp, "
        "lastUpdatedTime timestamp, dataSetId long"
    ),
    "datasets": (
        "id long, name string, writeProtected boolean, externalId string, description string, "
        "metadata map<string,string>, createdTime timestamp, lastUpdatedTime timestamp"
    ),
    "raw": ("key string, lastUpdatedTime timestamp, columns string"),
    "3dmodels": ("id long, name string, createdTime timestamp"),
    "3dmodelrevisions": ("id long, modelId long, status string, assetMappingCount long, createdTime timestamp"),
    "3dmodelrevisionnodes": ("id long, modelId long, revisionId long, name string"),
    "3dmodelrevisionmappings": ("nodeId long, assetId long, modelId long, revisionId long"),
}


def read_schema(resource: str) -> T.StructType:
    return T.StructType.fromDDL(READ_SCHEMAS[resource])


@dataclass(frozen=True)
class WriteRules:
    """How a resource accepts inserts, updates and deletes."""

    modes: tuple[str, ...] = ("abort", "update", "upsert", "delete", "insert_into")
    has_id: bool = True
    # Columns that a null in the source can clear (others ignore a null).
    clearable: tuple[str, ...] = ()
    # Columns that hold no null after a create, with the value used when none is given.
    defaults: tuple[tuple[str, object], ...] = ()
    required: tuple[str, ...] = ()
    # Without this column a row with an external id can only be an update.
    update_only_without: str | None = None
    delete_by: tuple[str, ...] = ("id", "externalId")
    may_ignore_unknown: bool = True


# Write rules per resource.
WRITE_RULES = {
    "assets": WriteRules(
        clearable=("description", "source", "externalId", "dataSetId"),
        required=("name",),
        update_only_without="name",
    ),
    "events": WriteRules(
        clearable=(
            "startTime", "endTime", "description", "type", "subtype", "source", "externalId", "dataSetId",
        ),
    ),
    "timeseries": WriteRules(
        clearable=("name", "externalId", "unit", "assetId", "description", "dataSetId", "unitExternalId"),
        defaults=(("isStep", False), ("isString", False)),
    ),
    "files": WriteRules(
        clearable=("externalId", "source", "dataSetId", "mimeType", "sourceCreatedTime", "sourceModifiedTime"),
        required=("name",),
        update_only_without="name",
        delete_by=("id",),
    ),
    "sequences": WriteRules(
        clearable=("externalId", "name", "description", "assetId", "dataSetId"),
        required=("columns",),
        delete_by=("id",),
        may_ignore_unknown=False,
    ),
    "labels": WriteRules(
        modes=("abort", "delete"), has_id=False, required=("externalId", "name"), delete_by=("externalId",)
    ),
    "relationships": WriteRules(
        has_id=False,
        clearable=("startTime", "endTime", "confidence", "dataSetId"),
        required=("sourceExternalId", "sourceType", "targetExternalId", "targetType"),
        delete_by=("externalId",),
    ),
    "datasets": WriteRules(
        modes=("abort", "update", "upsert", "insert_into"),
        clearable=("externalId", "name", "description"),
        required=("writeProtected",),
        update_only_without="name",
    ),
}
