"""The resources of ``Star`` as SQL common table expressions over the same files."""

from __future__ import annotations

VIEWS = {
    "assets": """
        SELECT 'region-' || r_regionkey AS externalId, r_name AS name, NULL::BIGINT AS parentId,
               NULL::VARCHAR AS parentExternalId, NULL::VARCHAR AS description, NULL::VARCHAR AS segment,
               'region' AS source, (r_regionkey + 1)::BIGINT AS id, (r_regionkey + 1)::BIGINT AS rootId,
               NULL::BIGINT AS dataSetId, NULL::VARCHAR AS label
        FROM region
        UNION ALL
        SELECT 'nation-' || n_nationkey, n_name, n_regionkey + 1, 'region-' || n_regionkey, NULL, NULL, 'nation',
               n_nationkey + 1000, n_regionkey + 1, n_nationkey, NULL
        FROM nation
        UNION ALL
        SELECT 'customer-' || c_custkey, c_name, c_nationkey + 1000, 'nation-' || c_nationkey, c_mktsegment,
               c_mktsegment, 'customer', c_custkey + 1000000, n_regionkey + 1, c_nationkey, c_mktsegment
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ev": """
        SELECT o_orderkey AS id, o_orderdate AS startTime,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 7 DAY END AS endTime,
               o_orderpriority AS type, nullif(o_orderstatus, 'P') AS subtype, o_orderstatus AS status,
               o_custkey + 1000000 AS assetId, 'order-' || o_orderkey AS externalId
        FROM orders""",
    "dp": """
        SELECT user_id AS id, 'user-' || user_id AS externalId, ts AS timestamp, value,
               epoch_us(ts) AS us, user_id % 2 = 0 AS isStep
        FROM events""",
    "sdp": """
        SELECT user_id + 10000000 AS id, 'text-' || user_id AS externalId, ts AS timestamp, event_type AS value
        FROM events""",
    "series": """
        SELECT user_id + CASE WHEN isString THEN 10000000 ELSE 0 END AS id,
               CASE WHEN isString THEN 'text-' ELSE 'user-' END || user_id AS externalId, isString,
               CASE WHEN NOT isString THEN ['bar', 'degC', 'm3'][user_id % 3 + 1] END AS unit,
               user_id + 1000000 AS assetId, user_id % 2 = 0 AS isStep
        FROM (SELECT DISTINCT user_id FROM events), (VALUES (false), (true)) k(isString)""",
    "rel": """
        SELECT l_orderkey || ':' || l_linenumber AS externalId, 'part-' || l_partkey AS sourceExternalId,
               'supplier-' || l_suppkey AS targetExternalId, l_shipdate AS startTime,
               round(l_discount * 10, 6) AS confidence, l_returnflag AS label
        FROM lineitem""",
    "seqrows": """
        SELECT user_id AS id, 'seq-' || user_id AS externalId, event_id AS rowNumber, value, event_type AS kind,
               json_extract_string(props, '$.k')::BIGINT AS k
        FROM events""",
    "nodes": """
        SELECT 'parts' AS space, 'part-' || p_partkey AS externalId, p_size::BIGINT AS version, p_type AS typeId
        FROM part
        UNION ALL
        SELECT 'suppliers', 'supplier-' || s_suppkey, NULL, NULL FROM supplier""",
    "edges": """
        SELECT 'supply' AS space,
               concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INTEGER,
                         epoch_us(l_shipdate) // 86400000000) AS externalId,
               l_linenumber::BIGINT AS version, 'flag-' || l_returnflag AS typeId,
               'part-' || l_partkey AS startId, 'supplier-' || l_suppkey AS endId,
               l_quantity AS quantity, l_discount AS discount
        FROM lineitem""",
    "lines": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::INTEGER,
                         epoch_us(l_shipdate) // 86400000000) AS key,
               l_shipdate AS lastUpdatedTime, l_returnflag AS rf, l_linestatus AS ls, l_returnflag = 'R' AS returned,
               round(l_extendedprice * 100)::BIGINT AS cents, l_linenumber AS num, l_partkey AS part,
               l_suppkey AS supp
        FROM lineitem""",
}


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause with the named views; more can follow after a comma."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts)
