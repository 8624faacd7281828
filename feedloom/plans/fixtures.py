"""Inputs that the registered queries derive from the driver tables.

Each input is a SELECT in the common subset of Spark SQL and ANSI SQL, with
table names in braces, so the same rows can be read by both engines.
"""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from . import property_model as M

# The driver tables. A declared schema saves a job per read that would look into the files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
TABLES = list(SCHEMAS)


def _pick(key: str, values: list[str]) -> str:
    """CASE expression that takes the value at index ``key % n``."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def _feed(code: str, *, dirty: bool = False) -> str:
    """A feed from line items: the subsidiaries of regions 0 and 1 report as ES, those of the others as IT."""
    terms = M.VALUE_TERMS[code]
    segments = list(terms["customer_segment"])
    month = "CASE WHEN l_linenumber = 6 THEN 13 ELSE month(l_shipdate) END" if dirty else "month(l_shipdate)"
    premium = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END" if dirty else "l_extendedprice"
    expressions = {
        "record_id": "l_orderkey * 10 + l_linenumber",
        "reporting_year": "CAST(year(l_shipdate) AS INT)",
        "reporting_month": f"CAST({month} AS INT)",
        "policy_number": f"'{code}-' || l_orderkey",
        "risk_type": _pick("l_partkey", list(terms["risk_type"])),
        "region": "n_name",
        "distribution_channel": _pick("l_linenumber", list(terms["distribution_channel"])),
        "net_written_premium_eur": "l_extendedprice * (1 - l_discount)",
        "gross_written_premium_eur": premium,
        "new_policies_count": "CAST(l_quantity AS INT)",
        "renewed_policies_count": "CAST(l_partkey % 60 AS INT)",
        "cancelled_policies_count": "CAST(l_suppkey % 5 AS INT)",
        "claims_reported_count": "l_linenumber",
        "claims_paid_count": "CAST(l_partkey % 8 AS INT)",
        "gross_claims_incurred_eur": "l_extendedprice * l_quantity / 50",
        "claims_reserve_eur": "l_extendedprice * l_quantity / 100",
        "management_expenses_eur": "l_extendedprice * l_tax",
        "commissions_eur": "l_extendedprice * l_discount",
        "loss_ratio": "l_quantity / 50",
        "customer_segment": (
            f"CASE l_returnflag WHEN 'A' THEN '{segments[0]}' WHEN 'N' THEN '{segments[1]}' ELSE '{segments[2]}' END"
        ),
        "risk_zone": "CASE l_linestatus WHEN 'F' THEN 'Zona A' ELSE 'Zona B' END",
        "primary_coverage": _pick("l_partkey", M.COVERAGES[code]),
        "currency": "'EUR'",
        "fecha_carga": "l_shipdate",
        "codice_agenzia_interno": "'IT-' || l_suppkey",
    }
    columns = ", ".join(f"{expressions[target or local]} AS {local}" for local, _, target in M.FEEDS[code])
    regions = "n_regionkey IN (0, 1)" if code == "ES" else "n_regionkey NOT IN (0, 1)"
    return (
        f"SELECT {columns} FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey "
        f"JOIN {{nation}} ON s_nationkey = n_nationkey WHERE {regions}"
    )


def _target(key: str) -> str:
    return _pick(key, M.TARGET_NAMES)


_LOCAL_NAMES = [n for code in ("ES", "IT") for n, _, _ in M.FEEDS[code]]
_LOCAL_TYPES = [
    {"BIGINT": "bigint", "INT": "int", "STRING": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp"}[t]
    for code in ("ES", "IT")
    for _, t, _ in M.FEEDS[code]
]

def _quoted(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


_FEED_COLUMNS = ", ".join(
    f"({n}, {_quoted(name)}, {_quoted('_'.join(t[:3] for t in name.split('_')).upper())}, {_quoted(kind.lower())}, {_quoted(target)})"
    for n, feed in enumerate((M.FEED_ES, M.FEED_IT))
    for name, kind, target in feed
)

SQL: dict[str, str] = {
    "feed_es": _feed("ES"),
    "feed_it": _feed("IT"),
    "feed_es_dirty": _feed("ES", dirty=True),
    "feed_it_dirty": _feed("IT", dirty=True),
    # One candidate column per order; each customer is a source system.
    "candidates": f"""
        SELECT o_orderkey AS candidate_id, 'SYS_' || o_custkey AS source_system, 'feed_' || o_custkey AS source_table,
          'col_' || o_orderkey AS local_column_name,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'bigint' WHEN '2-HIGH' THEN 'double' ELSE 'string' END
            AS local_data_type,
          CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'NO_MATCH' WHEN 2 THEN '' WHEN 3 THEN 'no_match'
            ELSE {_target('o_orderkey')} END AS proposed_global_column_name,
          CAST(NULL AS STRING) AS proposed_global_data_type,
          CASE o_orderkey % 4 WHEN 0 THEN 'DIRECT' WHEN 1 THEN 'SEMANTIC_TRANSLATION' WHEN 2 THEN 'DERIVED'
            ELSE NULL END AS proposed_match_type,
          'because ' || o_orderpriority AS mapping_rationale,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'MEDIUM'
            WHEN '5-LOW' THEN 'LOW' ELSE NULL END AS confidence,
          CASE WHEN o_orderkey % 9 IN (0, 2) THEN 'AI_ERROR' ELSE NULL END AS ai_error_status,
          CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'REJECTED'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'APPROVED' ELSE 'CORRECTED' END END AS review_status,
          CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'NO_MATCH'
            WHEN 2 THEN '' ELSE {_target('(o_orderkey + 1)')} END ELSE NULL END AS final_global_column_name,
          CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'DIRECT' ELSE NULL END AS final_match_type,
          CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 3 = 0 END AS mandatory_flag,
          CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 5 <> 0 THEN 'reviewer' || (o_custkey % 10) ELSE NULL END
            AS reviewed_by,
          CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 7 <> 0 THEN o_orderdate ELSE NULL END AS reviewed_at,
          CASE WHEN o_orderstatus = 'P' THEN 'no use for ' || o_orderpriority ELSE NULL END AS review_comment,
          CASE WHEN o_orderstatus <> 'O' THEN 'REVIEW_APP' ELSE NULL END AS app_decision_source,
          o_orderdate AS created_at, o_orderdate AS updated_at
        FROM {{orders}}""",
    "declared_mandatory": """
        SELECT 'SYS_' || o_custkey AS source_system, 'col_' || o_orderkey AS local_column_name
        FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "mapping_dictionary": f"""
        SELECT 'SYS_' || o_custkey AS source_system, 'feed_' || o_custkey AS source_table,
          CASE WHEN o_orderkey % 10 = 9 THEN 'old_' ELSE 'col_' END || o_orderkey AS local_column_name,
          CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'No_Match' WHEN 2 THEN ''
            ELSE {_target('(o_orderkey + 2)')} END AS global_column_name,
          CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'SEMANTIC_TRANSLATION' END AS match_type,
          'reviewer' || (o_custkey % 10) AS approved_by, o_orderdate AS approved_at,
          CASE o_orderstatus WHEN 'F' THEN 'v1' ELSE 'v2' END AS mapping_version,
          o_orderkey % 4 <> 0 AND o_orderstatus <> 'P' AS active_flag, 'kept' AS mapping_comment,
          o_orderdate AS created_at, o_orderdate AS updated_at
        FROM {{orders}}""",
    # New proposals for part of the same keys and for new ones.
    "staged_candidates": f"""
        SELECT o_orderkey + 1000000000 AS candidate_id, 'SYS_' || o_custkey AS source_system,
          'feed_' || o_custkey AS source_table,
          CASE WHEN o_orderkey % 5 = 0 THEN 'new_' ELSE 'col_' END || o_orderkey AS local_column_name,
          'string' AS local_data_type, {_target('(o_orderkey + 3)')} AS proposed_global_column_name,
          'STRING' AS proposed_global_data_type, 'DIRECT' AS proposed_match_type,
          'second look' AS mapping_rationale, 'HIGH' AS confidence, CAST(NULL AS STRING) AS ai_error_status,
          'PENDING' AS review_status, CAST(NULL AS STRING) AS final_global_column_name,
          CAST(NULL AS STRING) AS final_match_type, o_orderkey % 2 = 0 AS mandatory_flag,
          CAST(NULL AS STRING) AS reviewed_by, o_orderdate AS created_at, o_orderdate AS updated_at,
          CAST(NULL AS STRING) AS app_decision_source
        FROM {{orders}} WHERE o_orderpriority <> '5-LOW'""",
    # Review state to be synced: decided and reset rows, and keys that the candidates lack.
    "queue_state": f"""
        SELECT 'SYS_' || o_custkey AS source_system,
          CASE WHEN o_orderkey % 8 = 0 THEN 'gone_' ELSE 'col_' END || o_orderkey AS local_column_name,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'APPROVED' WHEN '2-HIGH' THEN 'CORRECTED'
            WHEN '3-MEDIUM' THEN 'REJECTED' ELSE 'PENDING' END AS review_status,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {_target('(o_orderkey + 4)')} ELSE NULL END
            AS final_global_column_name,
          'DIRECT' AS final_match_type, 'steward' AS reviewed_by, o_orderdate AS reviewed_at,
          'synced' AS review_comment, 'REVIEW_APP' AS app_decision_source, o_orderdate AS updated_at
        FROM {{orders}} WHERE o_orderstatus <> 'P'""",
    # Review queue: one row per customer; sources by nation number.
    "queue": f"""
        SELECT 'SYS_' || (c_custkey % 25) AS source_system, 'col_' || c_custkey AS local_column_name,
          'string' AS local_data_type, {_target('c_custkey')} AS proposed_global_column_name,
          'DIRECT' AS proposed_match_type, c_mktsegment AS mapping_rationale, 'HIGH' AS confidence,
          c_custkey % 2 = 0 AS mandatory_flag, 'v1' AS mapping_version,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'APPROVED' WHEN 'MACHINERY' THEN 'REJECTED'
            WHEN 'FURNITURE' THEN 'CORRECTED' ELSE 'PENDING' END AS review_status,
          CASE c_mktsegment WHEN 'BUILDING' THEN {_target('c_custkey')}
            WHEN 'FURNITURE' THEN {_target('(c_custkey + 1)')} ELSE NULL END AS final_global_column_name,
          CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'DIRECT' ELSE NULL END AS final_match_type,
          CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY') THEN 'first' ELSE NULL END AS reviewed_by,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN 'not needed' ELSE NULL END AS review_comment
        FROM {{customer}}""",
    "queue_rows": f"""
        SELECT 'SYS_' || (c_custkey % 25) AS source_system,
          CASE WHEN c_custkey % 6 = 0 THEN 'new_' ELSE 'col_' END || c_custkey AS local_column_name,
          'int' AS local_data_type, {_target('(c_custkey + 5)')} AS proposed_global_column_name,
          'DERIVED' AS proposed_match_type, 'again' AS mapping_rationale, 'LOW' AS confidence,
          c_custkey % 3 = 0 AS mandatory_flag, 'v2' AS mapping_version
        FROM {{customer}} WHERE c_acctbal >= 0""",
    # One decision per event: valid, invalid, and for keys outside the queue; many per key.
    "decisions": f"""
        SELECT 'SYS_' || (user_id * 11 % 25) AS source_system, 'col_' || (user_id * 11) AS local_column_name,
          event_id AS seq,
          CASE event_type WHEN 'click' THEN 'APPROVE' WHEN 'purchase' THEN 'CORRECT' WHEN 'error' THEN 'REJECT'
            WHEN 'signup' THEN 'RESET' ELSE 'ARCHIVE' END AS action,
          'user' || user_id AS action_by,
          CASE WHEN event_type = 'purchase' AND value > 20 THEN {_target('event_id')} ELSE NULL END AS final_global,
          CASE WHEN event_type = 'purchase' THEN 'SEMANTIC_TRANSLATION' ELSE NULL END AS final_match_type,
          CASE WHEN event_type = 'error' THEN CASE WHEN value > 30 THEN 'bad ' || event_id WHEN value > 10 THEN '   '
            ELSE NULL END ELSE '' END AS comment
        FROM {{events}}""",
    "audit_old": """
        SELECT event_id AS audit_id, 'SYS_' || user_id AS source_system, 'col_' || user_id AS local_column_name,
          'PENDING' AS old_review_status, 'APPROVED' AS new_review_status,
          CAST(NULL AS STRING) AS old_global_column_name, event_type AS new_global_column_name,
          CAST(NULL AS STRING) AS old_match_type, CAST(NULL AS STRING) AS new_match_type,
          'user' || user_id AS action_by, 'old' AS action_comment, 'REVIEW_APP' AS action_source
        FROM {events} WHERE event_type <> 'view'""",
    "audit_new": """
        SELECT event_id AS audit_id, 'SYS_' || user_id AS source_system, 'col_' || user_id AS local_column_name,
          'APPROVED' AS old_review_status, 'PENDING' AS new_review_status,
          event_type AS old_global_column_name, CAST(NULL AS STRING) AS new_global_column_name,
          'user' || user_id AS action_by, 'new' AS action_comment, 'REVIEW_APP' AS action_source
        FROM {events} WHERE event_type <> 'click'""",
    "eval_results": """
        SELECT 'run_' || CAST(CAST(ts AS DATE) AS STRING) AS run_id, 'SYS_' || user_id AS source_system,
          CASE event_type WHEN 'view' THEN 'auto_accept_rate' WHEN 'purchase' THEN 'review_load' ELSE 'accuracy' END
            AS metric_name,
          value AS metric_value,
          CASE event_type WHEN 'error' THEN 'LOW' WHEN 'signup' THEN 'HIGH' ELSE 'ALL' END AS slice,
          CAST(CAST(ts AS DATE) AS TIMESTAMP) AS evaluated_at, event_id
        FROM {events}""",
    "dq_results": """
        SELECT 'run_' || CAST(CAST(ts AS DATE) AS STRING) || '_' || user_id AS run_id,
          'SYS_' || user_id AS source_system, event_type || '_' || event_id AS check_name,
          CASE WHEN value > 60 THEN 'FAILED' WHEN value > 40 THEN 'WARNING' ELSE 'PASSED' END AS check_status,
          value AS metric_value, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS recorded_at, props AS details
        FROM {events}""",
    "runs": """
        SELECT 'run_' || event_id AS run_id, 'feed_alignment' AS workflow_name, event_type AS task_name,
          CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS task_status, ts AS started_at,
          CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS finished_at, user_id AS row_count,
          props AS message
        FROM {events}""",
    "usage": """
        SELECT 'run_' || event_id AS run_id, 'SYS_' || user_id AS source_system, 'COLUMN' AS mapping_type,
          event_type AS source_field_or_column, event_id AS candidate_rows, event_id % 7 AS success_rows,
          event_id % 5 AS failed_rows, event_id % 3 AS low_confidence_rows, value * 2 AS estimated_prompt_units,
          value AS estimated_response_units, value / 4 AS estimated_cost_eur, ts AS recorded_at
        FROM {events}""",
    # A wide inventory: one column per order under the names of the two feeds.
    "inventory": f"""
        SELECT 'SYS_' || o_custkey AS source_system, 'feed_' || o_custkey AS source_table,
          {_pick('o_orderkey', _LOCAL_NAMES)} || CASE WHEN o_orderkey % 97 = 0 THEN '_' || o_orderkey ELSE '' END
            AS local_column_name,
          {_pick('o_orderkey', _LOCAL_TYPES)} AS local_data_type,
          CASE o_orderkey % 3 WHEN 0 THEN 'Fire' WHEN 1 THEN 'Zone A' ELSE 'Robo' END AS sample_a,
          CASE o_orderkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'Agent' WHEN 2 THEN 'Flood' ELSE '7' END AS sample_b,
          CAST(o_orderkey AS INT) AS ordinal_position
        FROM {{orders}}""",
    # Inventory keys as in the candidates.
    "inventory_keys": """
        SELECT 'SYS_' || o_custkey AS source_system, 'col_' || o_orderkey AS local_column_name,
          o_orderpriority AS local_data_type FROM {orders}""",
    # Answer key for the candidates.
    "wide_key": f"""
        SELECT 'SYS_' || o_custkey AS source_system,
          CASE WHEN o_orderkey % 19 = 0 THEN 'lost_' ELSE 'col_' END || o_orderkey AS local_column_name,
          CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN upper({_target('o_orderkey')})
            ELSE {_target('o_orderkey')} END AS expected_global_column_name
        FROM {{orders}}""",
    # Replies as free text, some fenced, some broken.
    "replies": f"""
        SELECT event_id, CASE event_type
          WHEN 'click' THEN '```json' || chr(10) || '{{{{"global_column_name": "' || {_target('event_id')}
            || '", "match_type": "DIRECT", "rationale": "user ' || user_id || '", "confidence": "HIGH"}}}}' || chr(10)
            || '```'
          WHEN 'purchase' THEN 'Sure: {{{{"global_column_name": "NO_MATCH", "confidence": "LOW", "k": ' || user_id || '}}}}'
          WHEN 'signup' THEN '{{{{"global_column_name": "", "match_type": "DERIVED"}}}}'
          WHEN 'error' THEN 'no answer for ' || user_id
          ELSE CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '{{{{"global_column_name": null}}}}'
            ELSE '{{{{"global_column_name": ' || event_id || ', "match_type": 7}}}}' END END AS reply
        FROM {{events}}""",
    # One column per order for a source of its own; its name can be known from another source's dictionary.
    "example_columns": """
        SELECT 'SYS_0' AS source_system, 'col_' || o_orderkey AS local_column_name, 'string' AS local_data_type
        FROM {orders}""",
    "value_replies": """
        SELECT event_id, CASE event_type WHEN 'click' THEN 'risk_type' WHEN 'view' THEN 'risk_zone'
            ELSE 'distribution_channel' END AS source_field,
          CASE WHEN event_type = 'error' THEN 'none' ELSE
          'ok {{"v' || user_id || '": "Fire", "w' || event_id || '": "Zone A", "Corredor": "Broker", "x": null, "y": "no code"}} end'
          END AS reply
        FROM {events}""",
    # A target model of one column per part, before and after a change.
    "model_old": """
        SELECT p_brand AS target_table, 'col_' || p_partkey AS global_column_name, 'STRING' AS global_data_type,
          p_name AS business_definition, p_type AS example_text, p_size > 25 AS required_flag, 'risk' AS semantic_group,
          'first' AS created_by
        FROM {part} WHERE p_type <> 'PROMO'""",
    "model_new": """
        SELECT p_brand AS target_table, 'col_' || p_partkey AS global_column_name, 'INT' AS global_data_type,
          p_type AS business_definition, p_name AS example_text, p_size > 10 AS required_flag, 'time' AS semantic_group,
          'second' AS created_by
        FROM {part} WHERE p_type <> 'SMALL'""",
    "value_dict_old": """
        SELECT p_type AS source_field, 'SYS_' || p_size AS source_system, 'v' || p_partkey AS raw_value,
          CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS harmonized_value, 'APPROVED' AS approval_status,
          CASE WHEN p_partkey % 2 = 0 THEN 'auto:allowed-list' ELSE 'person' END AS approved_by,
          'v1' AS mapping_version, p_partkey % 3 <> 0 AS active_flag
        FROM {part} WHERE p_type <> 'PROMO'""",
    "value_dict_new": """
        SELECT p_type AS source_field, 'SYS_' || p_size AS source_system, 'v' || p_partkey AS raw_value,
          p_brand AS harmonized_value, 'APPROVED' AS approval_status, 'auto:allowed-list' AS approved_by,
          'v2' AS mapping_version, 1 = 1 AS active_flag
        FROM {part} WHERE p_type <> 'SMALL'""",
    "part_terms": """
        SELECT 'ALL' AS source_system, 'part' AS source_field, 'p' || p_partkey AS raw_value,
          p_name AS harmonized_value, p_type <> 'PROMO' AS active_flag FROM {part}""",
    "part_facts": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, 'ALL' AS source_system, 'p' || l_partkey AS part
        FROM {lineitem}""",
    "memberships": """
        SELECT 'user' || c_custkey AS user, CASE c_custkey % 10 WHEN 0 THEN 'admins'
            WHEN 1 THEN 'stewards_es' WHEN 2 THEN 'stewards_it' ELSE 'stewards_' || lower(c_mktsegment) END AS "group"
        FROM {customer}""",
    # Pairs of targets that differ in case only, or in more than that.
    "cased_targets": """
        SELECT 'SYS_' || o_custkey AS source_system, 'col_' || o_orderkey AS local_column_name,
          CASE o_orderkey % 6 WHEN 0 THEN 'Stra\u00dfe' WHEN 1 THEN 'k\u0131sa' WHEN 2 THEN '\u03a4\u039f\u03a3'
            WHEN 3 THEN 'regi\u00f3n' WHEN 4 THEN 'regi\u00f3n' ELSE '\ufb01re' END || o_custkey AS proposed,
          CASE o_orderkey % 6 WHEN 0 THEN 'STRASSE' WHEN 1 THEN 'kisa' WHEN 2 THEN '\u03c4\u03bf\u03c2'
            WHEN 3 THEN 'REGI\u00d3N' WHEN 4 THEN 'region' ELSE 'FIRE' END || o_custkey AS expected
        FROM {orders}""",
    # The columns of a feed for every customer, named in one of four styles: as they are, without vowels, three letters
    # of each token, or between a prefix and the nation's number.
    "styled_columns": f"""
        SELECT 'SYS_' || c_custkey AS source_system,
          CASE c_custkey % 8 WHEN 0 THEN 'plain' WHEN 1 THEN 'plain' WHEN 2 THEN 'no vowels' WHEN 3 THEN 'no vowels'
            WHEN 4 THEN 'three letters' WHEN 5 THEN 'three letters' ELSE 'wrapped' END AS style,
          CASE c_custkey % 8 WHEN 0 THEN full_name WHEN 1 THEN full_name
            WHEN 2 THEN upper(substr(full_name, 1, 1) || translate(substr(full_name, 2), 'aeiou', ''))
            WHEN 3 THEN upper(substr(full_name, 1, 1) || translate(substr(full_name, 2), 'aeiou', ''))
            WHEN 4 THEN short_name WHEN 5 THEN short_name ELSE 'dw_' || full_name || '_n' || c_nationkey END AS local_column_name,
          kind AS local_data_type, target AS global_column_name,
          CASE kind WHEN 'string' THEN c_mktsegment WHEN 'double' THEN c_custkey || '.5' WHEN 'timestamp' THEN '2024-01-31 10:00:00'
            ELSE CAST(c_custkey AS VARCHAR(20)) END AS sample_value
        FROM {{customer}} JOIN (VALUES {_FEED_COLUMNS}) AS v(language, full_name, short_name, kind, target)
          ON language = c_custkey % 2""",
}


def tables_of(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(text) if name})


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str, *, spread: Mapping[str, str] = {}) -> DataFrame:
    """A driver table or a derived input as a DataFrame.

    ``spread`` names tables of few bytes that become many rows, with a column by which they are spread over all tasks first.
    """
    if name in TABLES:
        return read(spark, sf_dir, name)
    text = SQL[name].replace('"group"', "`group`")
    tables = {t: read(spark, sf_dir, t) for t in tables_of(text)}
    # With a number of their own, as partitions of few bytes would be put together again.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.sql(text, **{t: df.repartition(tasks, spread[t]) if t in spread else df for t, df in tables.items()})


def ansi(name: str) -> str:
    """The same input as SQL over the plain table names."""
    return SQL[name].format(**{t: t for t in tables_of(SQL[name])})