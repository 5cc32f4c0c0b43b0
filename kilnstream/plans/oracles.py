"""SQL that states the registered queries' results directly over the tables.

It computes from the event columns themselves and never parses a message, so it
checks the message path independently.
"""

from kilnstream import schemas
from kilnstream.plans.stored_queries import (
    APPENDED_TAG, BATCHES, DAY_COLUMNS, INFO_MAX_BY_BATCH, INSERTED_DAY, INSERTED_TAG, values_list,
)
from kilnstream.sources.derived import TAG_TEMPLATE, TYPE_CODES

_NAMES = ("tag_id, mapping_key, alias, data_type_cd, info_min, info_max, worm_min, worm_max, "
          "emer_min, emer_max")

_TAGS = ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in TAG_TEMPLATE
)
_CODES = ", ".join(str(row) for row in TYPE_CODES)

BASE = f"""
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
         printf('%03d', user_id % 20) AS mm
  FROM events),
msg AS (
  SELECT *, 'Machine' || mm AS asset_id,
         'LOT__' || mm || '_' || printf('%05d', user_id) AS lot_no,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS word,
         CAST(CAST(year(ts) - 2000 AS DOUBLE) AS VARCHAR) AS yy,
         CAST(CAST(month(ts) AS DOUBLE) AS VARCHAR) AS mo,
         CAST(CAST(day(ts) AS DOUBLE) AS VARCHAR) AS dd,
         CAST(CAST(hour(ts) AS DOUBLE) AS VARCHAR) AS hh,
         CAST(CAST(minute(ts) AS DOUBLE) AS VARCHAR) AS mi,
         CAST(value AS VARCHAR) AS value_text,
         CAST(CAST(k AS DOUBLE) AS VARCHAR) AS k_text,
         strftime(ts, '%Y%m%d%H%M') AS minute_key
  FROM ev),
modelled AS (SELECT * FROM msg WHERE user_id % 20 % 4 <> 3),
machine AS (SELECT DISTINCT user_id % 20 AS m, 'Machine' || mm AS asset_id FROM ev),
tag({_NAMES}) AS (VALUES {_TAGS}),
code(code_group, code, code_name) AS (VALUES {_CODES}),
status AS (
  SELECT 'Machine' || mm AS asset_id,
         arg_max(event_type, (ts, user_id % 3, event_id)) AS asset_stat_cd,
         arg_max('S' || CAST(k % 3 AS VARCHAR), (ts, user_id % 3, event_id)) AS seq_proc_stat_cd,
         arg_max('G' || CAST(k % 2 AS VARCHAR), (ts, user_id % 3, event_id)) AS grow_proc_stat_cd
  FROM ev WHERE user_id % 20 % 4 <> 3 GROUP BY 1),
cell AS (
  SELECT m.event_id, m.asset_id, m.lot_no, m.minute_key, m.ts, m.user_id, t.*,
         CASE t.mapping_key
           WHEN '6' THEN CASE WHEN t.data_type_cd = 'D01' AND m.word = '' THEN '0.0'
                              ELSE m.word END
           WHEN '7' THEN m.value_text
           WHEN '100' THEN m.k_text END AS cell,
         CASE t.mapping_key WHEN '7' THEN m.value WHEN '100' THEN CAST(m.k AS DOUBLE) END AS num
  FROM modelled m CROSS JOIN tag t),
graded AS (
  SELECT *, CASE
    WHEN num < CAST(emer_min AS DOUBLE) OR num > CAST(emer_max AS DOUBLE) THEN '2'
    WHEN num < CAST(worm_min AS DOUBLE) OR num > CAST(worm_max AS DOUBLE) THEN '1'
    WHEN num < CAST(info_min AS DOUBLE) OR num > CAST(info_max AS DOUBLE) THEN '0'
    END AS level FROM cell),
alarm AS (
  SELECT event_id,
         lot_no || '_' || minute_key
           || CASE WHEN length(mapping_key) = 1 THEN '0' || mapping_key ELSE mapping_key END
           AS alarm_id,
         'SITE_00001' AS site_id, asset_id, tag_id, num AS alarm_val, level AS alarm_level_cd,
         '알람 발생 값 = ' || cell AS alarm_desc, 'N' AS confirm_yn
  FROM graded WHERE level IS NOT NULL)
"""


def _message(lot_end: str) -> str:
    return (
        "'{\"0\": ' || yy || ', \"1\": ' || mo || ', \"2\": ' || dd || ', \"3\": ' || hh "
        "|| ', \"4\": ' || mi || ', \"5\": \"' || lot_no || '" + lot_end + "\", \"6\": \"' || word "
        "|| '\", \"7\": ' || value_text || ', \"8\": ' || CAST(event_id AS VARCHAR) "
        "|| ', \"100\": ' || k_text || '}'"
    )


PADDED, REPAIRED = _message("  "), _message("")

WIDE = """
SELECT event_id, asset_id, word AS c6,
       CASE WHEN word = '' THEN '0.0' ELSE word END AS c6d,
       value_text AS c7, CAST(NULL AS VARCHAR) AS c8, k_text AS c100
FROM modelled"""

ALARM = "SELECT * FROM alarm"

STATUS_COLUMNS = "asset_stat_cd, seq_proc_stat_cd, grow_proc_stat_cd"

STATUS_UPDATE = f"""
SELECT s.site_id, m.asset_id,
       CASE WHEN s.site_id = 'SITE_00001' AND m.m % 4 = 3 THEN 'N' ELSE 'Y' END
         AS model_confirm_yn, {STATUS_COLUMNS}
FROM machine m CROSS JOIN (VALUES ('SITE_00001'), ('SITE_00002')) s(site_id)
LEFT JOIN status u ON u.asset_id = m.asset_id AND s.site_id = 'SITE_00001'"""

TAG_SCAN = """
SELECT 'SITE_00001' AS site_id, m.asset_id, t.tag_id, upper(t.alias) AS tag_nm, t.alias,
       t.mapping_key, {limits} c.code_name AS data_type_nm
FROM machine m CROSS JOIN tag t
LEFT JOIN code c ON c.code = t.data_type_cd AND c.code_group = 'DATA_TYPE_CD'"""

LIMITS = "".join(
    f"t.{level}_{side} AS alarm_{level}_{side}_val, "
    for level in ("info", "worm", "emer") for side in ("min", "max")
)

LOT_RUNS = """
, lagged AS (
  SELECT *, lag(word) OVER (PARTITION BY lot_no ORDER BY user_id % 3, event_id) AS before FROM msg)
SELECT lot_no, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (before IS NOT NULL AND before <> word) AS BIGINT) AS n_changes,
       arg_min(word, (user_id % 3, event_id)) AS first_word,
       arg_max(word, (user_id % 3, event_id)) AS last_word
FROM lagged GROUP BY 1"""

PARTS = """
, parts AS (
  SELECT p_partkey % 20 AS m, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1)"""

CHART = """
SELECT lot_no, minute_key AS minute, alias, CAST(count(*) AS BIGINT) AS n, min(num) AS min_val,
       max(num) AS max_val, arg_max(num, (ts, user_id % 3, event_id)) AS last_val
FROM cell WHERE num IS NOT NULL {of} GROUP BY 1, 2, 3"""

TAG_INFO = """
SELECT 'VTAG_' || CAST(p_partkey AS VARCHAR) AS TAG_ID, p_name AS TAG_NM,
       'Double' AS DATA_TYPE, p_type AS TAG_DESC, p_size * 1000 AS CYCLE,
       CAST(p_size AS VARCHAR) AS IMPORTANCE, 'TEMP_' || CAST(p_partkey AS VARCHAR) AS ALIAS,
       CAST(p_size AS DOUBLE) AS MIN_VALUE, p_retailprice AS MAX_VALUE, p_brand AS FORMAT
FROM part"""

DAYS = ("SELECT strftime(ts, '%Y') AS c01, strftime(ts, '%m') AS c02, strftime(ts, '%d') AS c03, "
        + ", ".join(f"CAST(NULL AS VARCHAR) AS {name}" for name in DAY_COLUMNS[3:])
        + " FROM events")

_REFRESH_CASES = " ".join(
    f"WHEN {i} THEN {limit}" for i, limit in enumerate(INFO_MAX_BY_BATCH)
)

REFRESH = f"""
SELECT CAST(event_id % {BATCHES} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n
FROM graded
WHERE level IN ('1', '2') OR num < CAST(info_min AS DOUBLE)
   OR (info_max IS NOT NULL AND num > CASE event_id % {BATCHES} {_REFRESH_CASES} END)
GROUP BY 1"""


def _over_messages() -> dict[str, str]:
    per_type = {
        "0": "DOUBLE", "1": "DOUBLE", "2": "DOUBLE", "3": "DOUBLE", "4": "DOUBLE",
        "5": "STRING", "6": "STRING", "7": "DOUBLE", "8": "INT32", "100": "DOUBLE",
    }
    kinds = ", ".join(f"('{key}', '{kind}')" for key, kind in per_type.items())
    return {
        "message_text": f"SELECT event_id, {PADDED} AS value FROM msg",
        "lot_blank_repair": f"SELECT event_id, {REPAIRED} AS value FROM msg",
        "parse_typed": "SELECT event_id, lot_no, value AS n7 FROM msg",
        "lot_extract": "SELECT event_id, lot_no FROM msg",
        "asset_from_lot": "SELECT event_id, asset_id FROM msg",
        "asset_from_status": "SELECT event_id, asset_id FROM msg",
        "enrich_document": "SELECT event_id, asset_id, '1' AS oper_stat FROM msg",
        "value_types": f"SELECT event_id, t.key, t.value_type FROM msg "
                       f"CROSS JOIN (VALUES {kinds}) t(key, value_type)",
        "value_types_wide_ints": "SELECT event_id, '8' AS key, CASE event_id % 4 WHEN 0 "
                                 "THEN 'INT_OVER_64' ELSE 'DOUBLE' END AS value_type FROM msg",
        "alarm_wide_ints": "SELECT event_id, tag_id, alarm_val, alarm_level_cd FROM alarm "
                           "UNION ALL SELECT event_id, 'T08', CASE event_id % 4 WHEN 2 "
                           "THEN 100.0 ELSE 9.0 END::DOUBLE, '0' FROM modelled "
                           "WHERE event_id % 4 IN (2, 3)",
        "quarantine_split": "SELECT event_id, CASE event_id % 4 "
                            "WHEN 1 THEN 'not a JSON document' "
                            "WHEN 3 THEN 'lot number missing or not a string' END "
                            "AS reject_reason FROM msg",
        "asset_scan": "SELECT 'SITE_00001' AS site_id, asset_id, "
                      "CASE WHEN m % 4 = 3 THEN 'N' ELSE 'Y' END AS model_confirm_yn FROM machine",
        "tag_scan": TAG_SCAN.format(limits=""),
        "tag_scan_limits": TAG_SCAN.format(limits=LIMITS),
        "code_lookup": "SELECT m.asset_id, t.tag_id, c.code_name AS data_type_nm FROM machine m "
                       "CROSS JOIN tag t LEFT JOIN code c ON c.code = t.data_type_cd",
        "modelled_filter": "SELECT event_id, asset_id FROM modelled",
        "unmodelled_documents": "SELECT event_id, asset_id FROM msg WHERE user_id % 20 % 4 = 3",
        "asset_tags": "SELECT m.asset_id, t.tag_id, t.alias FROM machine m CROSS JOIN tag t "
                      "WHERE m.m % 4 <> 3",
        "document_tags": "SELECT event_id, asset_id, tag_id, mapping_key FROM cell",
        "typed_cells": "SELECT event_id, asset_id, alias, cell FROM cell",
        "typed_cells_widened": "SELECT event_id, asset_id, alias, CASE WHEN mapping_key = '8' "
                               "THEN CAST(CAST(event_id AS DOUBLE) AS VARCHAR) ELSE cell END "
                               "AS cell FROM cell",
        "wide_rows": WIDE,
        "wide_rows_typed": "SELECT event_id, asset_id, word AS c6, "
                           "CASE WHEN word = '' THEN CAST(0 AS DOUBLE) END AS c6d, value AS c7, "
                           "CAST(NULL AS DOUBLE) AS c8, CAST(k AS DOUBLE) AS c100 FROM modelled",
        "wide_rows_pivot": WIDE,
        "wide_rows_one_asset": WIDE + " WHERE asset_id = 'Machine006'",
        "wide_rows_many_aliases": f"{PARTS} SELECT event_id, asset_id, 3 * n AS n_aliases, "
                                  "2 * n AS n_filled, "
                                  "CASE WHEN word = '' THEN '0.0' ELSE word END AS first_cell "
                                  "FROM modelled JOIN parts ON parts.m = user_id % 20",
        "document_tags_large_master": f"{PARTS} SELECT asset_id, "
                                      "'P' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') || '_' "
                                      "|| key AS tag_id, CAST(count(*) AS BIGINT) AS n, "
                                      "CAST(count(*) FILTER (key <> '9') AS BIGINT) AS n_values "
                                      "FROM modelled JOIN part ON p_partkey % 20 = user_id % 20 "
                                      "CROSS JOIN (VALUES ('6'), ('7'), ('9')) k(key) "
                                      "GROUP BY 1, 2",
        "modelled_filter_large_master": "SELECT event_id, asset_id FROM modelled",
        "alarm_levels": "SELECT event_id, tag_id, alarm_val, alarm_level_cd FROM alarm",
        "alarm_null_limits": "SELECT t.tag_id, CAST(count(a.tag_id) AS BIGINT) AS n FROM tag t "
                             "LEFT JOIN alarm a ON a.tag_id = t.tag_id GROUP BY 1",
        "alarm_time_key": "SELECT event_id, tag_id, minute_key || CASE WHEN "
                          "length(mapping_key) = 1 THEN '0' || mapping_key ELSE mapping_key END "
                          "AS time_key FROM cell",
        "alarm_history": ALARM,
        "latest_status": f"SELECT asset_id, {STATUS_COLUMNS} FROM status",
        "status_update": STATUS_UPDATE,
        "group_by_asset": "SELECT asset_id, CAST(count(*) AS BIGINT) AS n FROM msg GROUP BY 1",
        "group_by_lot": "SELECT lot_no, CAST(count(*) AS BIGINT) AS n FROM msg GROUP BY 1",
        "lot_payloads": f"SELECT lot_no, event_id, {REPAIRED} AS payload FROM msg",
        "lot_apply": LOT_RUNS,
        "lot_null_position": "SELECT lot_no, CAST(count(*) AS BIGINT) AS n FROM msg GROUP BY 1",
        "lot_command": "SELECT lot_no, row_number() OVER (PARTITION BY lot_no "
                       "ORDER BY event_id % 2, event_id) "
                       f"- 1 AS line_no, {REPAIRED} AS line, CAST(NULL AS VARCHAR) AS error "
                       "FROM msg",
        "lot_pipe": f"SELECT lot_no || chr(9) || {REPAIRED} AS line FROM msg",
        "lot_chart_series": CHART.format(of=""),
        "lot_chart_series_shared_alias": CHART.format(of="AND alias <> 'c100'"),
        "document_routing": "SELECT asset_id, CAST(count(*) AS BIGINT) AS n FROM msg GROUP BY 1",
        "document_scan": "SELECT event_id, asset_id FROM msg",
        "document_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM msg",
        "document_json_scan": "SELECT event_id, lot_no, value AS n7 FROM msg",
        "staging_targets": "SELECT 'documents_temp' AS target, CAST(count(*) AS BIGINT) AS n "
                           "FROM msg UNION ALL SELECT 'wide_rows_temp', count(*) FROM modelled "
                           "UNION ALL SELECT 'alarm_history_temp', count(*) FROM alarm",
        "generate_documents": "SELECT event_id AS test, user_id, event_type FROM msg",
        "stream_source_replay": f"SELECT event_id, {PADDED} AS value FROM msg",
        "stream_machine_job": ALARM,
        "stream_learning_job": WIDE,
        "stream_alias_added": "SELECT event_id, asset_id, word AS c6, "
                              "CASE WHEN event_id % 3 > 0 THEN CASE WHEN word = '' THEN '0.0' "
                              "ELSE word END END AS c6d, "
                              "CASE WHEN event_id % 3 > 1 THEN value_text END AS c7 FROM modelled",
        "stream_status_job": STATUS_UPDATE,
        "stream_status_late": STATUS_UPDATE,
        "stream_dim_refresh": REFRESH,
        "replay_gaps": "SELECT event_id, CAST(1 AS BIGINT) AS n, CAST(event_id // 100 % 3 = 1 "
                       "OR event_id % 7 = 2 AS BIGINT) AS batch_id FROM msg",
        "stream_duplicates": "SELECT event_id, CAST(1 AS BIGINT) AS n FROM msg",
        "document_compaction": "SELECT event_id, asset_id FROM msg",
        "status_versions": STATUS_UPDATE,
        "stream_chart_series": CHART.format(of=""),
        "stream_lot_lines": "SELECT event_id % 3 AS batch_id, lot_no, row_number() OVER "
                            "(PARTITION BY event_id % 3, lot_no ORDER BY user_id % 3, event_id) "
                            f"- 1 AS line_no, {REPAIRED} AS line, CAST(NULL AS VARCHAR) AS error "
                            "FROM msg",
        "stream_dim_replay": REFRESH,
        "modelled_filter_hot_key": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Machine006' "
                                   "ELSE asset_id END AS asset_id FROM msg WHERE event_id % 3 = 0 "
                                   "OR user_id % 20 % 4 <> 3",
    }


def _over_tag_info() -> dict[str, str]:
    columns = ", ".join(schemas.TAG_INFO_COLUMNS)
    return {
        "jdbc_scan": TAG_INFO,
        "sql_range_filter": f"SELECT * FROM ({TAG_INFO}) WHERE CYCLE > 8000",
        "limit_rows": f"SELECT * FROM ({TAG_INFO}) ORDER BY TAG_ID LIMIT 50",
        "sql_insert_values": f"SELECT * FROM ({TAG_INFO}) WHERE CYCLE > 8000 UNION ALL "
                             f"SELECT {_typed_tag(INSERTED_TAG)}",
        "jdbc_append": f"SELECT {columns} FROM ({TAG_INFO}) UNION ALL "
                       f"SELECT {_typed_tag(APPENDED_TAG)}",
        "jdbc_truncate_overwrite": TAG_INFO,
        "sql_insert_nulls": f"{DAYS} UNION ALL SELECT {values_list(INSERTED_DAY)}",
    }


def _typed_tag(row: tuple) -> str:
    doubles = ("MIN_VALUE", "MAX_VALUE")
    return ", ".join(
        f"CAST({values_list((value,))} AS DOUBLE)" if name in doubles else values_list((value,))
        for name, value in zip(schemas.TAG_INFO_COLUMNS, row)
    )


def oracle_sql() -> dict[str, str]:
    return {
        **{name: f"{BASE}{sql}" for name, sql in _over_messages().items()},
        **_over_tag_info(),
    }
