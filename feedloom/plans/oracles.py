"""The registered queries as ANSI SQL over the driver tables, written apart from the Spark code."""

from __future__ import annotations

from . import property_model as M
from .fixtures import SQL, ansi

ORACLES: dict[str, str] = {}


def _values(rows: list[tuple], columns: str) -> str:
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _shared() -> str:
    """Both feeds renamed to the target columns, values as delivered."""
    parts = []
    for code, feed in M.FEEDS.items():
        local = {target: name for name, _, target in feed if target}
        columns = ", ".join(f"{local[t]} AS {t}" for t in M.TARGET_NAMES)
        parts.append(
            f"SELECT {columns}, '{code}' AS source_country, '{M.SYSTEMS[code]}' AS source_system, "
            f"'v1' AS column_mapping_version FROM feed_{code.lower()}"
        )
    return " UNION ALL ".join(parts)


_TERMS = [
    (M.SYSTEMS[c], field, raw, code) for c, by in M.VALUE_TERMS.items() for field, terms in by.items()
    for raw, code in terms.items()
]


def _translated() -> str:
    kept = [t for t in M.TARGET_NAMES if t not in M.CATEGORICAL]
    looked = ", ".join(
        f"COALESCE((SELECT v.harmonized_value FROM terms v WHERE v.source_system = d.source_system "
        f"AND v.source_field = '{c}' AND v.raw_value = d.{c}), d.{c}) AS {c}"
        for c in M.CATEGORICAL
    )
    return (
        f"SELECT {', '.join(kept)}, {looked}, source_country, source_system, column_mapping_version, "
        "'APPROVED_COLUMN_AND_VALUE_MAPPING' AS mapping_status FROM delivered d"
    )


_MODEL_ROWS = [(n, t, g, r, n.replace("_", " ")) for n, t, r, g, _ in M.TARGETS]
_ALLOWED_ROWS = [(c, v) for c in M.CATEGORICAL for v in M.ALLOWED[c]]
_GLOSS_ROWS = sorted({(f, raw, code) for _, f, raw, code in _TERMS})

DERIVED: dict[str, str] = {
    "delivered": _shared(),
    "terms": _values(_TERMS, "source_system, source_field, raw_value, harmonized_value"),
    "shared": _translated(),
    "targets": _values(
        _MODEL_ROWS, "global_column_name, global_data_type, semantic_group, required_flag, business_definition"
    ),
    "examples": _values([(n, v) for n, _, _, _, ex in M.TARGETS for v in ex], "global_column_name, example"),
    "allowed": _values(_ALLOWED_ROWS, "source_field, allowed_value"),
    "value_glossary": _values(_GLOSS_ROWS, "source_field, raw_value, code"),
    "glossary": _values(M.GLOSSARY, "local_token, global_token"),
    "key": _values(
        [(M.SYSTEMS[c], n, t) for c, feed in M.FEEDS.items() for n, _, t in feed],
        "source_system, local_column_name, expected",
    ),
}
_NEEDS = {"delivered": ["feed_es", "feed_it"], "shared": ["delivered", "terms"]}


def _with(names: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return ", ".join(f"{n} AS ({ansi(n) if n in SQL else DERIVED[n]})" for n in ordered)


def oracle(name: str, uses: str, body: str) -> None:
    ORACLES[name] = f"WITH {_with(uses.split())} {body}" if uses else body


def _ratio(parts: list[str]) -> str:
    total = " + ".join(f"CAST(SUM(CAST({p} AS DECIMAL(38,18))) AS DOUBLE)" for p in parts)
    whole = "NULLIF(CAST(SUM(CAST(gross_written_premium_eur AS DECIMAL(38,18))) AS DOUBLE), 0)"
    return f"ROUND(({total}) / {whole}, 6)"


def _sum(column: str) -> str:
    return f"ROUND(CAST(SUM(CAST({column} AS DECIMAL(38,18))) AS DOUBLE), 4)"


LOSS = _ratio(["gross_claims_incurred_eur"])
EXPENSE = _ratio(["commissions_eur", "management_expenses_eur"])
COMBINED = _ratio(["gross_claims_incurred_eur", "commissions_eur", "management_expenses_eur"])
PERIOD = "make_date(reporting_year, reporting_month, 1)"

# KPIs
oracle(
    "kpi_combined_ratio_by_source_channel", "shared",
    f"SELECT source_country AS country, distribution_channel, {COMBINED} AS combined_ratio FROM shared GROUP BY 1, 2",
)
oracle(
    "kpi_by_source", "shared",
    f"""SELECT source_country AS country, {_sum('gross_written_premium_eur')} AS gross_written_premium,
    {_sum('net_written_premium_eur')} AS net_written_premium, {_sum('gross_claims_incurred_eur')} AS gross_claims_incurred,
    CAST(SUM(claims_reported_count) AS BIGINT) AS claims_reported, CAST(SUM(claims_paid_count) AS BIGINT) AS claims_paid,
    {_sum('commissions_eur')} AS commissions, {_sum('management_expenses_eur')} AS management_expenses,
    {LOSS} AS loss_ratio, {EXPENSE} AS expense_ratio, {COMBINED} AS combined_ratio,
    CAST(SUM(new_policies_count + renewed_policies_count - cancelled_policies_count) AS BIGINT)
      AS policies_in_force_change
    FROM shared GROUP BY 1""",
)
oracle(
    "kpi_all_dimensions", "shared",
    f"""SELECT source_country AS country, {PERIOD} AS reporting_period, distribution_channel, customer_segment,
    risk_zone, region, {_sum('gross_written_premium_eur')} AS gross_written_premium,
    CAST(SUM(claims_reported_count) AS BIGINT) AS claims_reported, {LOSS} AS loss_ratio
    FROM shared GROUP BY 1, 2, 3, 4, 5, 6""",
)
oracle(
    "kpi_loss_ratio_last3m", "shared",
    f"""SELECT source_country AS country, {LOSS} AS loss_ratio FROM shared
    WHERE {PERIOD} >= (SELECT MAX({PERIOD}) FROM shared) - INTERVAL 2 MONTH GROUP BY 1""",
)
oracle(
    "kpi_top_channel", "shared",
    f"""SELECT country, distribution_channel, combined_ratio FROM (SELECT *, RANK() OVER (PARTITION BY country
    ORDER BY exact DESC NULLS LAST) AS r FROM (SELECT source_country AS country, distribution_channel,
    {COMBINED} AS combined_ratio, {COMBINED.replace('ROUND(', '(').replace(', 6)', ')')} AS exact
    FROM shared GROUP BY 1, 2)) WHERE r = 1""",
)
oracle(
    "kpi_gwp_month_source", "shared",
    f"""SELECT {PERIOD} AS reporting_period, source_country AS country,
    {_sum('gross_written_premium_eur')} AS gross_written_premium FROM shared GROUP BY 1, 2""",
)
oracle(
    "kpi_claims_month_source", "shared",
    f"""SELECT source_country AS country, {PERIOD} AS reporting_period,
    CAST(SUM(claims_reported_count) AS BIGINT) AS claims_reported FROM shared GROUP BY 1, 2""",
)
oracle(
    "kpi_highest_loss_ratio", "shared",
    f"""SELECT country, reporting_period, loss_ratio FROM (SELECT *, RANK() OVER (ORDER BY exact DESC NULLS LAST) AS r
    FROM (SELECT source_country AS country, {PERIOD} AS reporting_period, {LOSS} AS loss_ratio,
    {LOSS.replace('ROUND(', '(').replace(', 6)', ')')} AS exact FROM shared GROUP BY 1, 2)) WHERE r = 1""",
)

# Projection
oracle("harmonized_rows", "shared", "SELECT * FROM shared")
oracle(
    "pad_and_cast", "",
    "SELECT o_orderkey AS record_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INT) END "
    "AS reporting_year, o_orderpriority AS distribution_channel, "
    + ", ".join(
        f"CAST(NULL AS {t.replace('STRING', 'VARCHAR')}) AS {n}" for n, t in M.MODEL.items()
        if n not in ("record_id", "reporting_year", "distribution_channel")
    )
    + " FROM orders",
)
oracle(
    "duplicate_target_first_wins", "",
    "SELECT o_orderkey AS record_id, o_orderpriority AS currency, CAST(NULL AS VARCHAR) AS region FROM orders",
)
_REAL = "global_column_name IS NOT NULL AND global_column_name <> '' AND upper(global_column_name) <> 'NO_MATCH'"
oracle(
    "column_mapping_report", "inventory_keys mapping_dictionary",
    f"""SELECT COALESCE(i.source_system, m.source_system) AS source_system,
    COALESCE(i.local_column_name, m.local_column_name) AS local_column_name, m.global_column_name,
    CASE WHEN m.global_column_name IS NULL THEN 'NOT_MAPPED' WHEN i.local_column_name IS NULL THEN 'NOT_IN_FEED'
      WHEN m.local_column_name = (SELECT MIN(o.local_column_name) FROM (SELECT * FROM mapping_dictionary
        WHERE active_flag AND {_REAL} AND local_column_name LIKE 'col_%') o
        WHERE o.source_system = m.source_system AND o.global_column_name = m.global_column_name) THEN 'MAPPED'
      ELSE 'SKIPPED_DUPLICATE' END AS column_status
    FROM inventory_keys i FULL OUTER JOIN (SELECT * FROM mapping_dictionary WHERE active_flag AND {_REAL}) m
    ON i.source_system = m.source_system AND i.local_column_name = m.local_column_name""",
)
oracle(
    "pending_columns", "inventory_keys mapping_dictionary",
    """SELECT i.* FROM inventory_keys i WHERE NOT EXISTS (SELECT 1 FROM mapping_dictionary m WHERE m.active_flag
    AND m.source_system = i.source_system AND m.local_column_name = i.local_column_name)""",
)
oracle(
    "active_mappings", "mapping_dictionary",
    f"""SELECT source_system, local_column_name, global_column_name, mapping_version FROM mapping_dictionary
    WHERE active_flag AND {_REAL}""",
)


# Profiling
def _inventory_oracle() -> str:
    parts = []
    for code, feed in M.FEEDS.items():
        for position, (name, kind, _) in enumerate(feed, start=1):
            values = f"list_slice(list_sort(list(DISTINCT {name})), 1, 5)"
            if kind == "DOUBLE":
                values = f"[printf('%.6f', x + 0.0) FOR x IN {values}]"
            elif kind == "TIMESTAMP":
                values = f"[strftime(x, '%Y-%m-%d %H:%M:%S') FOR x IN {values}]"
            text = f"array_to_string({values}, '; ')"
            parts.append(
                f"SELECT '{M.SYSTEMS[code]}' AS source_system, 'feed_{code.lower()}' AS source_table, "
                f"'{name}' AS local_column_name, {position} AS ordinal_position, "
                f"(SELECT {text} FROM feed_{code.lower()} WHERE {name} IS NOT NULL) AS samples"
            )
    return " UNION ALL ".join(parts)


oracle("inventory_samples", "feed_es feed_it", _inventory_oracle())
oracle(
    "required_profile", "shared",
    "SELECT source_country, COUNT(*) AS row_count, "
    + ", ".join(f"COUNT(DISTINCT {c}) AS distinct_{c}" for c in M.REQUIRED)
    + " FROM shared GROUP BY 1",
)
oracle(
    "distinct_values", "delivered",
    " UNION ALL ".join(
        f"SELECT DISTINCT source_system, '{c}' AS source_field, {c} AS raw_value FROM delivered WHERE {c} IS NOT NULL"
        for c in M.CATEGORICAL
    ),
)
oracle(
    "feed_counts", "feed_es feed_it",
    """SELECT 'es' AS feed, COUNT(*) AS "rows", COUNT(DISTINCT anio) AS files FROM feed_es UNION ALL
    SELECT 'it', COUNT(*), COUNT(DISTINCT anno_riferimento) FROM feed_it""",
)
oracle("rows_by_source", "shared", 'SELECT source_country, COUNT(*) AS "rows" FROM shared GROUP BY 1')

# Expectations
oracle(
    "expect_drop", "feed_es_dirty feed_it_dirty",
    """SELECT 'es' AS feed, id_registro AS id, mes AS "month", prima_bruta AS premium FROM feed_es_dirty
    WHERE prima_bruta >= 0 UNION ALL SELECT 'it', id_riga, mese_riferimento, premi_lordi_contabilizzati
    FROM feed_it_dirty WHERE premi_lordi_contabilizzati >= 0""",
)


def _expectation_oracle(damaged: bool = False) -> str:
    parts = []
    for code in ("es", "it"):
        names = [n for n, _, _ in M.FEEDS[code.upper()]]
        year, month, premium = names[1], names[2], names[8]
        if damaged:
            premium = f"CASE WHEN {names[0]} % 100 = 0 THEN NULL ELSE {premium} END"
        for rule, kind, test in (
            ("valid_period", "warn", f"{year} IS NOT NULL AND {month} BETWEEN 1 AND 12"),
            ("has_premium", "drop", f"{premium} >= 0"),
        ):
            parts.append(
                f"SELECT '{code}' AS feed, '{rule}' AS expectation, '{kind}' AS kind, "
                f"COUNT(*) FILTER (WHERE {test}) AS passed_records, "
                f"COUNT(*) - COUNT(*) FILTER (WHERE {test}) AS failed_records, "
                f"COUNT(*) FILTER (WHERE {premium} >= 0) AS output_rows FROM feed_{code}_dirty"
            )
    return " UNION ALL ".join(parts)


oracle("expect_metrics", "feed_es_dirty feed_it_dirty", _expectation_oracle())


# Quality
def _dq_oracle(probes: bool = True) -> str:
    """The checks of both feeds; ``probes`` adds a source without rows, absent columns and rules that break."""
    parts = []

    def add(name: str, status: str, metric: str, details: str, source: str = "shared") -> None:
        columns = f"'{name}' AS check_name, {status} AS check_status, CAST({metric} AS DOUBLE) AS metric_value, {details} AS details"
        parts.append(f"SELECT source_system, {columns} FROM {source} GROUP BY source_system")
        if probes:
            parts.append(f"SELECT 'EMPTY' AS source_system, {columns} FROM {source} WHERE FALSE HAVING COUNT(*) = 0")

    def rule(name: str, test: str, severity: str, text: str) -> None:
        n = f"COUNT(*) FILTER (WHERE {test})"
        add(name, f"CASE WHEN {n} = 0 THEN 'PASSED' ELSE '{severity}' END", n, f"'{text}: ' || {n} || ' violations'")

    add("row_count_parity", "'PASSED'", "COUNT(*)", "'raw=' || format('{:,}', COUNT(*)) || ', harmonized=' || format('{:,}', COUNT(*))")
    parts.extend(
        f"SELECT '{M.SYSTEMS[c]}', 'column_mapping_coverage', 'PASSED', 100.0, '14/14 mandatory columns have active dict entries'"
        for c in M.FEEDS
    )
    if probes:
        parts.append("SELECT 'EMPTY', 'column_mapping_coverage', 'PASSED', 100.0, '0/0 mandatory columns have active dict entries'")
    for c in M.REQUIRED:
        n = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        add(f"not_null_{c}", f"CASE WHEN {n} = 0 THEN 'PASSED' ELSE 'FAILED' END", n, f"{n} || ' null {c} values'")
    if probes:
        add("not_null_absent_column", "'FAILED'", "0", "'target column ''absent_column'' is missing'")
    for c, values in M.ALLOWED.items():
        listed = ", ".join(f"'{v}'" for v in values)
        rule(f"values_in_allowed_list_{c}", f"{c} NOT IN ({listed})", "WARNING", f"{c} values are in the configured allow-list")
    if probes:
        add("values_in_allowed_list_absent_category", "'WARNING'", "2", "'column is missing'")
    for r in M.RULES:
        rule(r.name, r.predicate, r.severity, r.text)
    for name in ("broken_rule", "stopping_rule", *(f"stopping_{x}" for x in M.STOPPING)) if probes else ():
        add(name, "'FAILED'", "0", "'predicate failed to evaluate'")
    n = "COUNT(*) FILTER (WHERE mapping_status <> 'APPROVED_COLUMN_AND_VALUE_MAPPING')"
    add("column_mapping_version_present", f"CASE WHEN {n} = 0 THEN 'PASSED' ELSE 'WARNING' END", n,
        f"{n} || ' rows without expected mapping_status flag'")
    return " UNION ALL ".join(parts)


oracle("dq_report", "shared", _dq_oracle())
oracle(
    "dq_untranslated", "delivered",
    "SELECT source_country, CAST(1 + " + " + ".join(
        f"CASE WHEN COUNT(*) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in M.ALLOWED[c])})) = 0 THEN 1 ELSE 0 END"
        for c in M.CATEGORICAL
    )
    + " AS BIGINT) AS passed, CAST(" + " + ".join(
        f"CASE WHEN COUNT(*) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in M.ALLOWED[c])})) > 0 THEN 1 ELSE 0 END"
        for c in M.CATEGORICAL
    )
    + " AS BIGINT) AS warning, CAST(0 AS BIGINT) AS failed, CAST(5 AS BIGINT) AS checks FROM delivered GROUP BY 1",
)
oracle(
    "dq_mapping_coverage", "declared_mandatory mapping_dictionary",
    """SELECT source_system, 'column_mapping_coverage' AS check_name,
    CASE WHEN COUNT(*) = COUNT(hit) THEN 'PASSED' ELSE 'WARNING' END AS check_status,
    ROUND(CAST(COUNT(hit) AS DOUBLE) / COUNT(*) * 100, 1) AS metric_value,
    COUNT(hit) || '/' || COUNT(*) || ' mandatory columns have active dict entries' AS details
    FROM (SELECT m.source_system, (SELECT 1 FROM mapping_dictionary x WHERE x.active_flag
      AND x.source_system = m.source_system AND x.local_column_name = m.local_column_name) AS hit
      FROM declared_mandatory m) GROUP BY 1""",
)
_DQ = "run_id, source_system, check_name, check_status, metric_value, details"
oracle(
    "dq_latest_run", "dq_results",
    f"SELECT {_DQ} FROM dq_results QUALIFY DENSE_RANK() OVER (PARTITION BY source_system ORDER BY recorded_at DESC) = 1",
)
oracle(
    "failed_checks_last_run", "dq_results",
    f"""SELECT {_DQ} FROM (SELECT * FROM dq_results QUALIFY DENSE_RANK() OVER (PARTITION BY source_system
    ORDER BY recorded_at DESC) = 1) WHERE check_status = 'FAILED'""",
)
oracle(
    "failed_checks_last_failed_run", "dq_results",
    f"""SELECT {_DQ} FROM dq_results WHERE check_status = 'FAILED' AND run_id = (SELECT run_id FROM dq_results
    WHERE check_status = 'FAILED' GROUP BY run_id ORDER BY MAX(recorded_at) DESC, run_id DESC LIMIT 1)""",
)

# Values
oracle(
    "translate_values", "shared",
    f"SELECT source_country, record_id, {', '.join(M.CATEGORICAL)}, primary_coverage, mapping_status FROM shared",
)
oracle(
    "translate_values_large", "part_facts part_terms",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, f.source_system, COALESCE(t.harmonized_value, f.part) AS part
    FROM part_facts f LEFT JOIN part_terms t ON t.active_flag AND t.raw_value = f.part""",
)
_FOUND = " UNION ALL ".join(
    f"SELECT DISTINCT source_system, '{c}' AS source_field, {c} AS raw_value FROM delivered WHERE {c} IS NOT NULL"
    for c in [*M.CATEGORICAL, "region"]
)
_PROPOSED = f"""SELECT f.source_system, f.source_field, f.raw_value, COALESCE(
    (SELECT MIN(a.allowed_value) FROM allowed a WHERE a.source_field = f.source_field
      AND lower(trim(a.allowed_value)) = lower(trim(f.raw_value))),
    (SELECT MIN(g.code) FROM value_glossary g WHERE g.source_field = f.source_field
      AND lower(trim(g.raw_value)) = lower(trim(f.raw_value)))) AS proposed FROM ({_FOUND}) f"""
oracle(
    "value_candidates", "delivered allowed value_glossary",
    f"""SELECT source_system, source_field, raw_value, proposed AS proposed_harmonized_value,
    CASE WHEN proposed IS NULL THEN 'LOW' ELSE 'HIGH' END AS confidence,
    CASE WHEN proposed IS NULL THEN 'PENDING' ELSE 'APPROVED' END AS review_status,
    proposed AS final_harmonized_value, CASE WHEN proposed IS NOT NULL THEN 'auto:allowed-list' END AS reviewed_by
    FROM ({_PROPOSED})""",
)
oracle(
    "value_prompt", "delivered allowed",
    f"""SELECT f.source_field, 'Give one allowed value for every local value of ''' || f.source_field
    || '''. Allowed: ' || (SELECT string_agg(allowed_value, ', ' ORDER BY allowed_value) FROM allowed a
      WHERE a.source_field = f.source_field) || '. Local: ' || string_agg(DISTINCT raw_value, ', ' ORDER BY raw_value)
    || '. Answer with one JSON object from local to allowed value, null where none is safe.' AS prompt
    FROM ({_FOUND}) f WHERE f.source_field <> 'region' GROUP BY f.source_field""",
)
_OMITTED = min(M.VALUE_TERMS["ES"]["risk_type"])
oracle(
    "replied_values", "delivered terms",
    f"""SELECT f.source_system, f.source_field, f.raw_value, v.harmonized_value AS final_harmonized_value,
    CASE WHEN v.harmonized_value IS NULL THEN 'PENDING' ELSE 'APPROVED' END AS review_status,
    CASE WHEN f.source_system = '{M.SYSTEMS["IT"]}' AND f.source_field = 'distribution_channel' THEN 'AI_ERROR' END AS ai_error_status
    FROM ({" UNION ".join(f"SELECT source_system, '{c}' AS source_field, {c} AS raw_value FROM delivered WHERE {c} IS NOT NULL" for c in M.CATEGORICAL)}) f
    LEFT JOIN terms v ON v.source_system = f.source_system AND v.source_field = f.source_field AND v.raw_value = f.raw_value
    AND NOT (f.source_system = '{M.SYSTEMS["ES"]}' AND f.source_field = 'risk_type' AND f.raw_value = '{_OMITTED}')
    AND NOT (f.source_system = '{M.SYSTEMS["IT"]}' AND f.source_field = 'distribution_channel')""",
)
oracle(
    "propose_flow", "example_columns mapping_dictionary",
    f"""SELECT e.local_column_name, COALESCE(m.global_column_name, 'NO_MATCH') AS proposed_global_column_name, 'LOW' AS confidence
    FROM example_columns e LEFT JOIN (SELECT local_column_name, global_column_name FROM mapping_dictionary
    WHERE source_system <> 'SYS_0' AND active_flag AND {_REAL}) m ON m.local_column_name = e.local_column_name""",
)
oracle(
    "parse_value_reply", "value_replies allowed",
    r"""SELECT r.event_id, r.source_field, k AS raw_value, CASE WHEN EXISTS (SELECT 1 FROM allowed a
    WHERE a.source_field = r.source_field AND a.allowed_value = json_extract_string(r.j, '$."' || k || '"'))
    THEN json_extract_string(r.j, '$."' || k || '"') END AS proposed_value, CAST(NULL AS VARCHAR) AS ai_error_status
    FROM (SELECT event_id, source_field, j, unnest(json_keys(j)) AS k FROM (SELECT event_id, source_field,
      CAST(regexp_extract(reply, '\{.*\}', 0, 's') AS JSON) AS j FROM value_replies WHERE reply LIKE '%{%')) r
    UNION ALL SELECT event_id, source_field, NULL, NULL, 'AI_ERROR' FROM value_replies WHERE reply NOT LIKE '%{%'""",
)

# Matching
oracle(
    "prompt_text", "inventory",
    "SELECT source_system, ordinal_position, 'Column ' || local_column_name || ' (' || local_data_type || '), e.g. ' "
    "|| sample_a || '; ' || sample_b || '. monthly feed: " + ", ".join([*M.TARGET_NAMES, "NO_MATCH"])
    + "; it''s brief' || chr(10) || 'Approved pairs of other sources (local -> target):' || chr(10) "
    "|| 'prima_neta -> net_written_premium_eur' AS prompt FROM inventory",
)
oracle(
    "parse_reply", "replies",
    r"""SELECT event_id, g AS proposed_global_column_name, json_extract_string(j, '$.match_type') AS proposed_match_type,
    json_extract_string(j, '$.rationale') AS mapping_rationale, json_extract_string(j, '$.confidence') AS confidence,
    CASE WHEN g IS NULL OR g = '' THEN 'AI_ERROR' END AS ai_error_status
    FROM (SELECT event_id, j, json_extract_string(j, '$.global_column_name') AS g FROM (SELECT event_id,
      TRY_CAST(regexp_extract(reply, '\{.*\}', 0, 's') AS JSON) AS j FROM replies))""",
)


def _proposals(inventory: str, samples: str, with_examples: bool) -> str:
    """Scores of every column and target that share a token or an example, best first."""
    tokens = "list_distinct([x for x in string_split(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_') if x <> ''])"
    family = (
        "CASE WHEN lower({0}) IN ('int', 'bigint') THEN 'integer' WHEN lower({0}) = 'double' THEN 'floating' "
        "WHEN lower({0}) LIKE 'timestamp%' THEN 'time' ELSE 'string' END"
    )
    example = (
        "(SELECT COUNT(*) > 0 FROM key k WHERE k.source_system = 'IT_PROPERTY_RAW' "
        "AND k.local_column_name = i.local_column_name AND k.expected = t.global_column_name)"
        if with_examples else "FALSE"
    )
    return f"""
    SELECT *, ROUND(0.6 * CASE WHEN n_shared > 0 THEN n_shared / (n_local + n_target - n_shared) ELSE 0 END
      + 0.15 * fits + 0.15 * hits + 0.1 * example, 6) AS score FROM (
    SELECT i.*, t.global_column_name AS target, CAST(len(list_intersect(lt.words, tt.words)) AS DOUBLE) AS n_shared,
      len(lt.words) AS n_local, len(tt.words) AS n_target, lt.translated,
      CASE WHEN {family.format('i.local_data_type')} = {family.format('t.global_data_type')} THEN 1.0 ELSE 0.0 END AS fits,
      CAST(len(list_intersect({samples}, tt.examples)) AS DOUBLE) / greatest(len(list_distinct({samples})), 1) AS hits,
      CASE WHEN {example} THEN 1 ELSE 0 END AS example
    FROM {inventory} i
    JOIN (SELECT local_column_name, list_distinct(list(COALESCE(g.global_token, w))) AS words,
        bool_or(g.global_token IS NOT NULL AND g.global_token <> w) AS translated
      FROM (SELECT local_column_name, unnest({tokens.format('local_column_name')}) AS w
        FROM (SELECT DISTINCT local_column_name FROM {inventory})) n LEFT JOIN glossary g ON g.local_token = n.w
      GROUP BY 1) lt ON lt.local_column_name = i.local_column_name
    CROSS JOIN targets t
    JOIN (SELECT global_column_name, {tokens.format('global_column_name')} AS words, list(example) AS examples
      FROM examples GROUP BY 1) tt ON tt.global_column_name = t.global_column_name)
    WHERE n_shared > 0 OR example = 1"""


oracle(
    "propose_mappings", "inventory targets examples glossary key",
    f"""SELECT i.source_system, i.ordinal_position, i.local_column_name, COALESCE(p.target, 'NO_MATCH')
      AS proposed_global_column_name,
    CASE WHEN p.target IS NULL THEN 'NO_MATCH' WHEN lower(i.local_column_name) = p.target THEN 'DIRECT'
      WHEN (p.translated AND p.n_shared > 0) OR p.example = 1 THEN 'SEMANTIC_TRANSLATION' ELSE 'DIRECT' END
      AS proposed_match_type,
    CASE WHEN p.score >= 0.65 THEN 'HIGH' WHEN p.score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
    COALESCE(p.score, 0.0) AS score FROM inventory i LEFT JOIN (
      SELECT * FROM ({_proposals('inventory', '[i.sample_a, i.sample_b]', True)})
      QUALIFY ROW_NUMBER() OVER (PARTITION BY ordinal_position ORDER BY score DESC, target) = 1) p
    ON p.ordinal_position = i.ordinal_position""",
)


def _feed_inventory() -> str:
    """The columns of both feeds with their five smallest values; fractional and time columns match no code."""
    types = {"BIGINT": "bigint", "INT": "int", "STRING": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}
    parts = []
    for code, feed in M.FEEDS.items():
        for name, kind, _ in feed:
            values = (
                "['-']" if kind in ("DOUBLE", "TIMESTAMP")
                else f"(SELECT [CAST(x AS VARCHAR) for x in list_slice(list_sort(list(DISTINCT {name})), 1, 5)] "
                f"FROM feed_{code.lower()} WHERE {name} IS NOT NULL)"
            )
            flagged = "TRUE" if name in M.MANDATORY[code] else "FALSE"
            parts.append(
                f"SELECT '{M.SYSTEMS[code]}' AS source_system, '{name}' AS local_column_name, "
                f"'{types[kind]}' AS local_data_type, {values} AS samples, {flagged} AS mandatory_flag"
            )
    return " UNION ALL ".join(parts)


oracle(
    "propose_feeds", "feed_es feed_it targets examples glossary key",
    f"""SELECT i.source_system, i.local_column_name, COALESCE(p.target, 'NO_MATCH') AS proposed, k.expected,
    CASE WHEN p.score >= 0.65 THEN 'HIGH' WHEN p.score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
    CASE WHEN p.score >= 0.65 THEN 'HIGH' WHEN p.score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS band,
    lower(COALESCE(p.target, 'NO_MATCH')) = lower(COALESCE(k.expected, 'no_match')) AS correct, i.mandatory_flag,
    CASE WHEN p.target IS NULL THEN 'NO_MATCH' WHEN lower(i.local_column_name) = p.target THEN 'DIRECT'
      WHEN p.translated THEN 'SEMANTIC_TRANSLATION' ELSE 'DIRECT' END AS proposed_match_type
    FROM (SELECT * FROM feed_inventory) i
    JOIN key k ON k.source_system = i.source_system AND k.local_column_name = i.local_column_name
    LEFT JOIN (SELECT * FROM ({_proposals('feed_inventory', 'i.samples', False)})
      QUALIFY ROW_NUMBER() OVER (PARTITION BY source_system, local_column_name ORDER BY score DESC, target) = 1) p
    ON p.source_system = i.source_system AND p.local_column_name = i.local_column_name""",
)
ORACLES["propose_feeds"] = ORACLES["propose_feeds"].replace(
    "key AS (", f"feed_inventory AS MATERIALIZED ({_feed_inventory()}), key AS (", 1
)
oracle(
    "approved_examples", "mapping_dictionary",
    f"""SELECT local_column_name, global_column_name, source_system FROM mapping_dictionary
    WHERE source_system <> 'SYS_1' AND active_flag AND {_REAL}
    ORDER BY local_column_name, global_column_name, source_system LIMIT 60""",
)
oracle(
    "stage_candidates", "replies declared_mandatory",
    r"""SELECT source_system, local_column_name, g AS proposed_global_column_name,
    CASE WHEN g IS NULL OR g = '' THEN 'AI_ERROR' END AS ai_error_status, 'PENDING' AS review_status,
    CAST(NULL AS VARCHAR) AS final_global_column_name,
    source_system = 'SYS_1' AND local_column_name IN (SELECT local_column_name FROM declared_mandatory) AS mandatory_flag
    FROM (SELECT 'SYS_' || (event_id % 10) AS source_system, 'col_' || event_id AS local_column_name,
      json_extract_string(TRY_CAST(regexp_extract(reply, '\{.*\}', 0, 's') AS JSON), '$.global_column_name') AS g
      FROM replies)""",
)

# Evaluation
_SCORED = """(SELECT k.source_system, k.local_column_name, c.proposed_global_column_name AS proposed,
    k.expected_global_column_name AS expected, c.confidence,
    COALESCE(upper(NULLIF(c.confidence, '')), 'UNKNOWN') AS band,
    COALESCE(c.ai_error_status, '') = '' AND lower(COALESCE(NULLIF(c.proposed_global_column_name, ''), 'no_match'))
      = lower(COALESCE(NULLIF(k.expected_global_column_name, ''), 'no_match')) AS correct
    FROM wide_key k LEFT JOIN candidates c ON c.source_system = k.source_system
    AND c.local_column_name = k.local_column_name)"""
oracle(
    "eval_overall", "wide_key candidates",
    f"""SELECT source_system, COUNT(*) AS n_columns, COUNT(*) FILTER (WHERE correct) AS n_correct,
    ROUND(COUNT(*) FILTER (WHERE correct) / CAST(COUNT(*) AS DOUBLE), 6) AS accuracy,
    ROUND(COUNT(*) FILTER (WHERE correct AND band = 'HIGH') / CAST(COUNT(*) AS DOUBLE), 6) AS auto_accept_rate,
    ROUND(COUNT(*) FILTER (WHERE NOT correct) / CAST(COUNT(*) AS DOUBLE), 6) AS review_load FROM {_SCORED} GROUP BY 1""",
)


def _bands(scored: str) -> str:
    return f"""SELECT b.source_system, b.band, COUNT(s.band) AS n, COUNT(*) FILTER (WHERE s.correct) AS correct,
    ROUND(COALESCE(COUNT(*) FILTER (WHERE s.correct) / NULLIF(CAST(COUNT(s.band) AS DOUBLE), 0), 0), 6) AS accuracy,
    ROUND(COUNT(s.band) / CAST(MAX(z.size) AS DOUBLE), 6) AS share
    FROM (SELECT DISTINCT source_system, band FROM {scored} UNION SELECT DISTINCT source_system, f.band
      FROM {scored} CROSS JOIN (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) AS f(band)) b
    JOIN (SELECT source_system, COUNT(*) AS size FROM {scored} GROUP BY 1) z ON z.source_system = b.source_system
    LEFT JOIN {scored} s ON s.source_system = b.source_system AND s.band = b.band GROUP BY 1, 2"""


oracle("eval_by_band", "wide_key candidates", _bands(_SCORED))
oracle(
    "eval_errors", "wide_key candidates",
    f"SELECT source_system, local_column_name, proposed, expected, confidence FROM {_SCORED} WHERE NOT correct",
)
_MEAN = "ROUND(AVG(CASE WHEN {} THEN 1.0 ELSE 0.0 END), 6)"
oracle(
    "eval_metric_rows", "wide_key candidates",
    f"""SELECT 'run' AS run_id, source_system, 'accuracy' AS metric_name, accuracy AS metric_value, band AS slice
    FROM ({_bands(_SCORED)}) UNION ALL
    SELECT 'run', source_system, 'accuracy', {_MEAN.format('correct')}, 'ALL' FROM {_SCORED} GROUP BY 2 UNION ALL
    SELECT 'run', source_system, 'auto_accept_rate', {_MEAN.format("correct AND band = 'HIGH'")}, 'ALL'
    FROM {_SCORED} GROUP BY 2 UNION ALL
    SELECT 'run', source_system, 'review_load', {_MEAN.format('NOT correct')}, 'ALL' FROM {_SCORED} GROUP BY 2""",
)
oracle(
    "latest_metric", "eval_results",
    """SELECT source_system, metric_name, metric_value FROM eval_results WHERE slice = 'ALL' QUALIFY ROW_NUMBER()
    OVER (PARTITION BY source_system, metric_name ORDER BY evaluated_at DESC, run_id DESC, metric_value DESC) = 1""",
)
oracle(
    "latest_eval_run", "eval_results",
    """SELECT run_id, source_system, metric_name, metric_value, slice, event_id FROM eval_results QUALIFY DENSE_RANK()
    OVER (PARTITION BY source_system ORDER BY evaluated_at DESC) = 1""",
)

# State changes
oracle(
    "merge_model", "model_old model_new",
    """SELECT COALESCE(o.target_table, n.target_table) AS target_table,
    COALESCE(o.global_column_name, n.global_column_name) AS global_column_name,
    COALESCE(n.global_data_type, o.global_data_type) AS global_data_type,
    COALESCE(n.business_definition, o.business_definition) AS business_definition,
    COALESCE(n.example_text, o.example_text) AS example_values,
    COALESCE(n.required_flag, o.required_flag) AS required_flag,
    COALESCE(n.semantic_group, o.semantic_group) AS semantic_group, COALESCE(o.created_by, n.created_by) AS created_by
    FROM model_old o FULL OUTER JOIN model_new n ON o.target_table = n.target_table
    AND o.global_column_name = n.global_column_name""",
)


def _merge_candidates() -> str:
    refreshed = {
        "local_data_type", "proposed_global_column_name", "proposed_global_data_type", "proposed_match_type",
        "mapping_rationale", "confidence", "ai_error_status", "mandatory_flag", "updated_at", "app_decision_source",
    }
    names = [
        "candidate_id", "source_system", "source_table", "local_column_name", "local_data_type",
        "proposed_global_column_name", "proposed_global_data_type", "proposed_match_type", "mapping_rationale",
        "confidence", "ai_error_status", "review_status", "final_global_column_name", "final_match_type",
        "mandatory_flag", "reviewed_by", "review_comment", "app_decision_source", "created_at", "updated_at",
    ]
    hit = "c.review_status = 'PENDING' AND s.local_column_name IS NOT NULL"
    old = [f"CASE WHEN {hit} THEN s.{n} ELSE c.{n} END AS {n}" if n in refreshed else f"c.{n}" for n in names]
    new = [f"CAST(NULL AS VARCHAR) AS {n}" if n == "review_comment" else f"s.{n}" for n in names]
    samples = f"CASE WHEN {hit} THEN s.local_data_type ELSE c.local_data_type END AS local_sample_values"
    match = "s.source_system = c.source_system AND s.local_column_name = c.local_column_name"
    return (
        f"SELECT {', '.join(old)}, {samples} FROM candidates c LEFT JOIN staged_candidates s ON {match} UNION ALL "
        f"SELECT {', '.join(new)}, s.local_data_type FROM staged_candidates s "
        f"WHERE NOT EXISTS (SELECT 1 FROM candidates c WHERE {match})"
    )


oracle("merge_candidates", "candidates staged_candidates", _merge_candidates())
_SYNCED = [
    "review_status", "final_global_column_name", "final_match_type", "reviewed_by", "reviewed_at", "review_comment",
    "app_decision_source", "updated_at",
]
oracle(
    "sync_decisions", "candidates queue_state",
    "SELECT c.source_system, c.local_column_name, c.proposed_global_column_name, "
    + ", ".join(f"CASE WHEN q.source_system IS NULL THEN c.{n} ELSE q.{n} END AS {n}" for n in _SYNCED)
    + """ FROM candidates c LEFT JOIN queue_state q ON q.source_system = c.source_system
    AND q.local_column_name = c.local_column_name""",
)
_AUDIT = (
    "audit_id, source_system, local_column_name, old_review_status, new_review_status, old_global_column_name, "
    "new_global_column_name, {}, action_by, action_comment, action_source"
)
oracle(
    "append_audit", "audit_old audit_new",
    f"""SELECT {_AUDIT.format('old_match_type, new_match_type')} FROM audit_old UNION ALL
    SELECT {_AUDIT.format('NULL, NULL')} FROM audit_new n WHERE NOT EXISTS (SELECT 1 FROM audit_old o
    WHERE o.source_system = n.source_system AND o.audit_id = n.audit_id)""",
)
_RESOLVED = """(SELECT source_system, source_table, local_column_name, global_column_name, match_type,
    COALESCE(reviewed_by, 'system') AS approved_by, COALESCE(reviewed_at, TIMESTAMP '2030-01-01 00:00:00') AS approved_at,
    'v9' AS mapping_version, TRUE AS active_flag, review_comment AS mapping_comment,
    TIMESTAMP '2030-01-01 00:00:00' AS created_at, TIMESTAMP '2030-01-01 00:00:00' AS updated_at
    FROM (SELECT *, CASE review_status WHEN 'CORRECTED' THEN final_global_column_name
      WHEN 'APPROVED' THEN COALESCE(final_global_column_name, proposed_global_column_name) END AS global_column_name,
      COALESCE(final_match_type, proposed_match_type) AS match_type FROM candidates
      WHERE review_status IN ('APPROVED', 'CORRECTED'))
    WHERE global_column_name IS NOT NULL AND global_column_name <> '' AND upper(global_column_name) <> 'NO_MATCH')"""
oracle("resolve_dictionary", "candidates", f"SELECT * FROM {_RESOLVED}")


def _merge_dictionary() -> str:
    kept = {"source_system", "source_table", "local_column_name", "created_at"}
    names = [
        "source_system", "source_table", "local_column_name", "global_column_name", "match_type", "approved_by",
        "approved_at", "mapping_version", "active_flag", "mapping_comment", "created_at", "updated_at",
    ]
    match = "s.source_system = m.source_system AND s.local_column_name = m.local_column_name"
    old = [f"m.{n}" if n in kept else f"CASE WHEN s.source_system IS NULL THEN m.{n} ELSE s.{n} END AS {n}" for n in names]
    return (
        f"SELECT {', '.join(old)} FROM mapping_dictionary m LEFT JOIN {_RESOLVED} s ON {match} UNION ALL "
        f"SELECT {', '.join('s.' + n for n in names)} FROM {_RESOLVED} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM mapping_dictionary m WHERE {match})"
    )


oracle("merge_dictionary", "mapping_dictionary candidates", _merge_dictionary())
oracle(
    "deactivate_stale", "mapping_dictionary candidates",
    f"""SELECT m.source_system, m.local_column_name, m.active_flag AND ok AS active_flag,
    CASE WHEN m.active_flag AND NOT ok THEN TIMESTAMP '2030-01-01 00:00:00' ELSE m.updated_at END AS updated_at
    FROM (SELECT d.*, EXISTS (SELECT 1 FROM {_RESOLVED} s WHERE s.source_system = d.source_system
      AND s.local_column_name = d.local_column_name) AS ok FROM mapping_dictionary d) m""",
)
oracle(
    "merge_value_dictionary", "value_dict_old value_dict_new",
    """SELECT o.source_field, o.source_system, o.raw_value,
    CASE WHEN hit THEN n_value ELSE o.harmonized_value END AS harmonized_value,
    o.approval_status, CASE WHEN hit THEN 'auto:allowed-list' ELSE o.approved_by END AS approved_by,
    CASE WHEN hit THEN 'v2' ELSE o.mapping_version END AS mapping_version, hit OR o.active_flag AS active_flag
    FROM (SELECT a.*, b.harmonized_value AS n_value, b.raw_value IS NOT NULL
      AND (a.approved_by = 'auto:allowed-list' OR a.harmonized_value IS NULL) AS hit
      FROM value_dict_old a LEFT JOIN value_dict_new b ON a.source_field = b.source_field
      AND a.source_system = b.source_system AND a.raw_value = b.raw_value) o
    UNION ALL SELECT source_field, source_system, raw_value, harmonized_value, approval_status, approved_by,
    mapping_version, active_flag FROM value_dict_new n WHERE NOT EXISTS (SELECT 1 FROM value_dict_old o
    WHERE o.source_field = n.source_field AND o.source_system = n.source_system AND o.raw_value = n.raw_value)""",
)


def _upsert_queue() -> str:
    refreshed = [
        "local_data_type", "proposed_global_column_name", "proposed_match_type", "mapping_rationale", "confidence",
        "mandatory_flag", "mapping_version",
    ]
    rest = ["final_global_column_name", "final_match_type", "reviewed_by", "review_comment"]
    match = "r.source_system = q.source_system AND r.local_column_name = q.local_column_name"
    hit = "r.source_system IS NOT NULL AND q.review_status = 'PENDING'"
    old = ", ".join(f"CASE WHEN {hit} THEN r.{n} ELSE q.{n} END AS {n}" for n in refreshed)
    return (
        f"SELECT q.source_system, q.local_column_name, {old}, q.review_status, {', '.join('q.' + n for n in rest)}, "
        f"{hit} AS changed FROM queue q LEFT JOIN queue_rows r ON {match} UNION ALL "
        f"SELECT r.source_system, r.local_column_name, {', '.join('r.' + n for n in refreshed)}, 'PENDING', "
        f"NULL, NULL, NULL, NULL, TRUE FROM queue_rows r WHERE NOT EXISTS (SELECT 1 FROM queue q WHERE {match})"
    )


oracle("upsert_queue", "queue queue_rows", _upsert_queue())

# Review
_REASON = """CASE WHEN d.action NOT IN ('APPROVE', 'CORRECT', 'REJECT', 'RESET') THEN 'unknown action'
    WHEN d.action = 'REJECT' AND trim(COALESCE(d.comment, '')) = '' THEN 'REJECT needs a comment'
    WHEN d.action = 'CORRECT' AND d.final_global IS NULL THEN 'CORRECT needs a target'
    WHEN q.local_column_name IS NULL THEN 'not in the queue' END"""
_MATCH = "q.source_system = d.source_system AND q.local_column_name = d.local_column_name"
_APPLIED = f"""(SELECT d.*, q.review_status AS old_status, q.proposed_global_column_name AS proposed,
    q.final_global_column_name AS old_final,
    CASE d.action WHEN 'APPROVE' THEN 'APPROVED' WHEN 'CORRECT' THEN 'CORRECTED' WHEN 'REJECT' THEN 'REJECTED'
      ELSE 'PENDING' END AS new_status,
    CASE d.action WHEN 'APPROVE' THEN q.proposed_global_column_name WHEN 'CORRECT' THEN d.final_global END AS new_global,
    CASE d.action WHEN 'APPROVE' THEN q.proposed_match_type WHEN 'CORRECT' THEN d.final_match_type END AS new_type
    FROM decisions d LEFT JOIN queue q ON {_MATCH} WHERE {_REASON} IS NULL)"""
oracle(
    "apply_decisions", "queue decisions",
    f"""SELECT q.source_system, q.local_column_name, q.local_data_type, q.proposed_global_column_name,
    q.proposed_match_type, q.mapping_rationale, q.confidence, q.mandatory_flag, q.mapping_version,
    COALESCE(d.new_status, q.review_status) AS review_status,
    CASE WHEN d.seq IS NULL THEN q.final_global_column_name ELSE d.new_global END AS final_global_column_name,
    CASE WHEN d.seq IS NULL THEN q.final_match_type ELSE d.new_type END AS final_match_type,
    CASE WHEN d.seq IS NULL THEN q.reviewed_by ELSE d.action_by END AS reviewed_by,
    CASE WHEN d.seq IS NULL THEN q.review_comment ELSE d.comment END AS review_comment
    FROM queue q LEFT JOIN (SELECT * FROM {_APPLIED} QUALIFY ROW_NUMBER() OVER (PARTITION BY source_system,
      local_column_name ORDER BY seq DESC) = 1) d ON {_MATCH}""",
)
oracle(
    "audit_rows", "queue decisions",
    f"""SELECT source_system, local_column_name, seq,
    CASE WHEN n = 1 THEN old_status ELSE before_status END AS old_review_status, new_status AS new_review_status,
    COALESCE(CASE WHEN n = 1 THEN old_final ELSE before_global END, proposed) AS old_global_column_name,
    new_global AS new_global_column_name, action_by, comment AS action_comment, 'REVIEW_APP' AS action_source
    FROM (SELECT *, ROW_NUMBER() OVER w AS n, LAG(new_status) OVER w AS before_status,
      LAG(new_global) OVER w AS before_global FROM {_APPLIED}
      WINDOW w AS (PARTITION BY source_system, local_column_name ORDER BY seq))""",
)
oracle(
    "rejected_decisions", "queue decisions",
    f"""SELECT d.source_system, d.local_column_name, d.seq, d.action, {_REASON} AS reject_reason
    FROM decisions d LEFT JOIN queue q ON {_MATCH} WHERE {_REASON} IS NOT NULL""",
)
oracle(
    "decide_from_key", "candidates wide_key",
    """SELECT source_system, local_column_name, CAST(0 AS BIGINT) AS seq, action, 'key-reader' AS action_by,
    CASE WHEN action = 'CORRECT' THEN expected END AS final_global,
    CASE WHEN action = 'CORRECT' THEN 'SEMANTIC_TRANSLATION' END AS final_match_type,
    CASE action WHEN 'REJECT' THEN 'The key has no target for this column.'
      WHEN 'CORRECT' THEN 'Proposed was ' || COALESCE(proposed, 'nothing') ELSE '' END AS comment
    FROM (SELECT c.source_system, c.local_column_name, k.expected_global_column_name AS expected,
      c.proposed_global_column_name AS proposed, CASE WHEN k.expected_global_column_name IS NULL THEN 'REJECT'
      WHEN lower(COALESCE(c.proposed_global_column_name, '')) = lower(k.expected_global_column_name) THEN 'APPROVE'
      ELSE 'CORRECT' END AS action FROM candidates c LEFT JOIN wide_key k ON k.source_system = c.source_system
      AND k.local_column_name = c.local_column_name WHERE c.review_status = 'PENDING')""",
)


def _decided(test: str, status: str, comment: str, target: str | None, kind: str | None) -> str:
    hit = f"review_status = 'PENDING' AND COALESCE({test}, FALSE)"
    final = f"CASE WHEN {hit} THEN {target} ELSE final_global_column_name END" if target else "final_global_column_name"
    match_type = f"CASE WHEN {hit} THEN {kind} ELSE final_match_type END" if kind else "final_match_type"
    return f"""SELECT source_system, local_column_name, CASE WHEN {hit} THEN '{status}' ELSE review_status END
    AS review_status, {final} AS final_global_column_name, {match_type} AS final_match_type,
    CASE WHEN {hit} THEN 'steward' ELSE reviewed_by END AS reviewed_by,
    CASE WHEN {hit} THEN '{comment}' ELSE review_comment END AS review_comment FROM candidates"""


oracle(
    "bulk_approve", "candidates",
    _decided(
        "(mandatory_flag AND ai_error_status IS NULL AND upper(proposed_global_column_name) <> 'NO_MATCH')", "APPROVED",
        "Bulk approved after review", "proposed_global_column_name", "proposed_match_type",
    ),
)
oracle(
    "bulk_approve_all", "candidates",
    _decided(
        "(ai_error_status IS NULL AND proposed_global_column_name IS NOT NULL)", "APPROVED",
        "Bulk approved after review", "proposed_global_column_name", "proposed_match_type",
    ),
)
oracle(
    "correct_rows", "candidates",
    _decided("(confidence = 'LOW')", "CORRECTED", "Corrected after review", "'region'", "'SEMANTIC_TRANSLATION'"),
)
oracle("reject_rows", "candidates", _decided("(confidence IS NULL)", "REJECTED", "no business field", None, None))
_NO_FINAL = "(final_global_column_name IS NULL OR final_global_column_name = '' OR upper(final_global_column_name) = 'NO_MATCH')"
oracle(
    "review_gate", "candidates declared_mandatory",
    f"""SELECT source_system, local_column_name, 'PENDING' AS reason FROM candidates
    WHERE mandatory_flag AND review_status = 'PENDING' UNION ALL
    SELECT source_system, local_column_name, 'NO_TARGET' FROM candidates
    WHERE mandatory_flag AND review_status <> 'PENDING' AND {_NO_FINAL} UNION ALL
    SELECT source_system, local_column_name, 'MISSING' FROM declared_mandatory m WHERE NOT EXISTS (SELECT 1
    FROM candidates c WHERE c.mandatory_flag AND c.source_system = m.source_system
    AND c.local_column_name = m.local_column_name)""",
)
oracle(
    "gate_preview", "candidates",
    """SELECT source_system, local_column_name, review_status, mandatory_flag, proposed_global_column_name, confidence,
    ai_error_status, 'BLOCKING' AS issue_type FROM candidates WHERE mandatory_flag AND (review_status = 'PENDING'
    OR (review_status = 'REJECTED' AND (final_global_column_name IS NULL OR final_global_column_name = '')))""",
)
oracle(
    "publish_ready", "candidates",
    f"""SELECT source_system, COUNT(*) FILTER (WHERE mandatory_flag AND (review_status = 'PENDING' OR {_NO_FINAL})) = 0
    AS publish_ready FROM candidates GROUP BY 1""",
)
oracle(
    "pending_view", "candidates",
    """SELECT candidate_id, source_system, local_column_name, local_data_type, proposed_global_column_name,
    proposed_global_data_type, proposed_match_type, mapping_rationale, confidence, ai_error_status, review_status,
    mandatory_flag, created_at FROM candidates WHERE review_status = 'PENDING'""",
)
oracle(
    "low_confidence_view", "candidates",
    """SELECT candidate_id, source_system, local_column_name, local_data_type, proposed_global_column_name,
    proposed_match_type, confidence, ai_error_status, review_status, mandatory_flag, mapping_rationale
    FROM candidates WHERE upper(confidence) = 'LOW' OR ai_error_status IS NOT NULL""",
)
oracle(
    "readiness_view", "candidates",
    """SELECT source_system, local_column_name AS mandatory_column_name, review_status, final_global_column_name,
    final_match_type, reviewed_by, reviewed_at, app_decision_source, review_status IN ('APPROVED', 'CORRECTED')
    AS is_ready FROM candidates WHERE mandatory_flag""",
)
oracle(
    "mandatory_status", "candidates",
    """SELECT source_system, local_column_name, local_data_type, proposed_global_column_name, proposed_match_type,
    confidence, ai_error_status, review_status, final_global_column_name, reviewed_by, reviewed_at
    FROM candidates WHERE mandatory_flag""",
)
oracle(
    "rejected_report", "candidates",
    """SELECT source_system, local_column_name, proposed_global_column_name, review_status, review_comment, reviewed_by,
    reviewed_at FROM candidates WHERE review_status = 'REJECTED'""",
)
oracle("review_queue", "queue", "SELECT * FROM queue WHERE review_status <> 'PENDING'")
oracle(
    "coverage_view", "targets candidates",
    """SELECT t.global_column_name, t.global_data_type, t.semantic_group, t.required_flag, t.business_definition,
    c.source_system, c.local_column_name, c.proposed_match_type, c.confidence, c.review_status,
    CASE WHEN c.review_status IN ('APPROVED', 'CORRECTED') THEN 'MAPPED' WHEN c.review_status = 'REJECTED' THEN 'REJECTED'
      WHEN c.review_status = 'PENDING' THEN 'PENDING' WHEN c.local_column_name IS NULL THEN 'UNMAPPED'
      ELSE 'UNKNOWN' END AS coverage_status
    FROM targets t LEFT JOIN candidates c
    ON t.global_column_name = COALESCE(c.final_global_column_name, c.proposed_global_column_name)""",
)
oracle(
    "latest_mapping_summary", "candidates mapping_dictionary",
    """SELECT c.source_system, c.local_column_name, c.local_data_type, c.proposed_global_column_name,
    COALESCE(m.global_column_name, c.proposed_global_column_name) AS active_global_column_name, c.proposed_match_type,
    COALESCE(m.match_type, c.proposed_match_type) AS active_match_type, c.confidence, c.review_status, c.mandatory_flag,
    c.reviewed_by, c.reviewed_at, m.local_column_name IS NOT NULL AS in_active_dictionary, m.mapping_version
    FROM candidates c LEFT JOIN mapping_dictionary m ON c.source_system = m.source_system
    AND c.local_column_name = m.local_column_name AND m.active_flag""",
)
oracle(
    "active_dictionary", "mapping_dictionary",
    """SELECT source_system, local_column_name, global_column_name, match_type, mapping_version, active_flag,
    approved_by, approved_at, mapping_comment FROM mapping_dictionary WHERE active_flag""",
)
oracle(
    "mapping_lineage", "mapping_dictionary",
    """SELECT source_system, local_column_name, global_column_name, match_type, mapping_version
    FROM mapping_dictionary WHERE source_system = 'SYS_1' AND global_column_name = 'net_written_premium_eur'""",
)

# Summaries
oracle(
    "review_summary", "candidates",
    """SELECT source_system, review_status, mandatory_flag, confidence, COUNT(*) AS "count",
    COUNT(ai_error_status) AS ai_error_count FROM candidates GROUP BY 1, 2, 3, 4""",
)
oracle(
    "status_summary", "queue",
    'SELECT source_system, review_status, mandatory_flag, COUNT(*) AS "count" FROM queue GROUP BY 1, 2, 3',
)
oracle(
    "status_columns", "candidates",
    """SELECT review_status, mandatory_flag, COUNT(*) AS "count", list(local_column_name ORDER BY local_column_name) AS "columns"
    FROM candidates GROUP BY 1, 2""",
)
oracle(
    "queue_counters", "candidates",
    """SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE review_status = 'PENDING') AS pending,
    COUNT(*) FILTER (WHERE review_status = 'APPROVED') AS approved,
    COUNT(*) FILTER (WHERE review_status = 'CORRECTED') AS corrected,
    COUNT(*) FILTER (WHERE review_status = 'REJECTED') AS rejected,
    COUNT(*) FILTER (WHERE review_status IN ('APPROVED', 'CORRECTED')) AS approved_or_corrected,
    COUNT(*) FILTER (WHERE mandatory_flag AND review_status = 'PENDING') AS mandatory_pending FROM candidates""",
)
oracle(
    "review_coverage", "candidates",
    """SELECT source_system, COUNT(*) AS total, COUNT(*) FILTER (WHERE ok) AS resolved,
    ROUND(COUNT(*) FILTER (WHERE ok) / CAST(COUNT(*) AS DOUBLE) * 100, 1) AS coverage,
    COUNT(*) FILTER (WHERE ok AND mandatory_flag) AS mandatory_resolved,
    COUNT(*) FILTER (WHERE NOT ok AND mandatory_flag) AS mandatory_unresolved
    FROM (SELECT *, review_status IN ('APPROVED', 'CORRECTED') AS ok FROM candidates) GROUP BY 1""",
)
oracle(
    "confidence_pivot", "candidates",
    "SELECT confidence, "
    + ", ".join(
        f"COUNT(*) FILTER (WHERE review_status = '{n}') AS \"{n}\"" for n in ("PENDING", "APPROVED", "CORRECTED", "REJECTED")
    )
    + " FROM candidates WHERE confidence IS NOT NULL GROUP BY 1",
)
oracle(
    "approved_count", "candidates",
    "SELECT source_system, COUNT(*) FILTER (WHERE review_status = 'APPROVED') AS \"columns\" FROM candidates GROUP BY 1",
)

# Operations
oracle(
    "usage_metrics", "candidates",
    """SELECT 'run' AS run_id, source_system, 'COLUMN' AS mapping_type, source_system AS source_field_or_column,
    COUNT(*) AS candidate_rows, COUNT(*) FILTER (WHERE ai_error_status IS NULL AND review_status = 'PENDING')
      AS success_rows, COUNT(ai_error_status) AS failed_rows,
    COUNT(*) FILTER (WHERE upper(confidence) = 'LOW') AS low_confidence_rows,
    CAST(COUNT(*) * 200 AS DOUBLE) AS estimated_prompt_units, CAST(COUNT(*) * 80 AS DOUBLE) AS estimated_response_units,
    ROUND(CAST(COUNT(*) * 280 AS DOUBLE) / 1000 * 0.002, 6) AS estimated_cost_eur FROM candidates GROUP BY 2""",
)
oracle(
    "recent_runs", "runs",
    """SELECT task_name, task_status, row_count, started_at,
    ROUND((floor(epoch(finished_at)) - floor(epoch(started_at))) / 60.0, 1) AS duration_min, message
    FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 20""",
)
oracle(
    "recent_usage", "usage",
    """SELECT mapping_type, source_field_or_column, candidate_rows, success_rows, failed_rows, low_confidence_rows,
    estimated_prompt_units, estimated_response_units, estimated_cost_eur, recorded_at FROM usage
    WHERE source_system = 'SYS_7' ORDER BY recorded_at DESC, run_id DESC LIMIT 10""",
)
oracle(
    "log_run", "runs",
    """SELECT run_id, task_name, task_status, row_count, message FROM runs
    UNION ALL SELECT 'this', 'log_run', 'DONE', COUNT(*), 'logged' FROM runs""",
)

# Security and model
oracle("row_filter", "shared", "SELECT source_country, record_id FROM shared WHERE lower(source_country) = 'es'")
oracle("row_filter_privileged", "shared", "SELECT source_country, record_id FROM shared")
oracle(
    "translate_one_source", "delivered terms",
    "SELECT source_country, record_id, " + ", ".join(
        f"COALESCE((SELECT v.harmonized_value FROM terms v WHERE v.source_system = d.source_system AND d.source_country = 'ES' "
        f"AND v.source_field = '{c}' AND v.raw_value = d.{c}), d.{c}) AS {c}"
        for c in M.CATEGORICAL
    )
    + ", 'APPROVED_COLUMN_' || CASE source_country WHEN 'ES' THEN 'AND_VALUE_' ELSE '' END || 'MAPPING' AS mapping_status FROM delivered d",
)
oracle(
    "small_money", "",
    """SELECT l_returnflag, ROUND(CAST(SUM(CAST(l_extendedprice * (1 - l_discount) * l_tax / 1000 AS DECIMAL(38,18))) AS DOUBLE), 6)
    AS amount FROM lineitem GROUP BY 1""",
)
oracle(
    "row_entitlements", "memberships",
    """SELECT DISTINCT "user", CASE WHEN "group" = 'admins' THEN '*'
    ELSE regexp_replace("group", '^stewards_', '') END AS scope FROM memberships WHERE "user" <> 'user3'
    UNION SELECT 'user3', '*'""",
)
oracle(
    "money_totals", "shared",
    "SELECT source_country, "
    + ", ".join(
        f"{_sum(n)} AS {n}" for n, t, _, g, _ in M.TARGETS if g in ("premium", "claims", "expenses") and t == "DOUBLE"
    )
    + " FROM shared GROUP BY 1",
)
oracle(
    "categorical_targets", "shared allowed",
    "SELECT a.source_field, a.allowed_value, COUNT(u.v) AS n FROM allowed a LEFT JOIN ("
    + " UNION ALL ".join(f"SELECT '{c}' AS f, {c} AS v FROM shared" for c in M.CATEGORICAL)
    + ") u ON u.f = a.source_field AND u.v = a.allowed_value GROUP BY 1, 2",
)

# Sources and sinks
oracle(
    "read_answer_key", "wide_key",
    "SELECT source_system, local_column_name, expected_global_column_name FROM wide_key",
)


def _dirty(where: str) -> str:
    parts = []
    for code in ("es", "it"):
        ids, premium, month = (M.FEEDS[code.upper()][i][0] for i in (0, 8, 2))
        bad = f"{ids} % 100 = 0"
        parts.append(
            f"SELECT '{code}' AS feed, {ids} AS id, {month} AS \"month\", CASE WHEN {bad} THEN NULL ELSE {premium} END "
            f"AS premium, CASE WHEN {bad} THEN 'n/a' END AS rescued_premium, "
            f"CASE WHEN {month} % 3 <> 0 THEN {M.FEEDS[code.upper()][22][0]} END AS currency, "
            f"CASE WHEN {month} % 3 = 0 THEN 'n' || {ids} END AS rescued_note FROM feed_{code}_dirty"
        )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE {where}"


oracle("rescue_rows", "feed_es_dirty feed_it_dirty", _dirty("TRUE"))
oracle("stream_counts", "feed_es_dirty feed_it_dirty", _expectation_oracle(damaged=True))
oracle("stream_ingest", "feed_es_dirty feed_it_dirty", _dirty("premium >= 0"))
oracle(
    "provenance", "feed_es_dirty feed_it_dirty",
    """SELECT 'es' AS feed, printf('%d%02d', anio, mes) AS yyyymm, COUNT(*) AS n FROM feed_es_dirty GROUP BY 2 UNION ALL
    SELECT 'it', printf('%d%02d', anno_riferimento, mese_riferimento), COUNT(*) FROM feed_it_dirty GROUP BY 2""",
)
oracle(
    "exact_sums", "",
    """SELECT l_linenumber AS line,
    CAST(SUM(CAST(FLOOR(l_extendedprice) AS HUGEINT)) * 3 AS DOUBLE) AS huge,
    CAST(SUM(CAST(FLOOR(l_extendedprice) AS HUGEINT)) AS DOUBLE) AS mixed,
    CASE WHEN l_linenumber = 6 AND BOOL_OR(l_partkey % 97 = 0) THEN 'nan' WHEN l_linenumber = 7 AND BOOL_OR(l_partkey % 97 = 0) THEN 'inf'
    WHEN l_linenumber < 6 THEN 'none' END AS wild FROM lineitem GROUP BY 1""",
)
oracle(
    "header_drift", "feed_es_dirty feed_it_dirty",
    " UNION ALL ".join(
        f"""SELECT DISTINCT '{code}' AS feed, printf('%d%02d', {y}, {m}) AS yyyymm,
        CASE WHEN {m} % 3 = 0 THEN '{cur}' ELSE '' END AS missing_columns,
        CASE WHEN {m} % 3 = 0 THEN 'note' ELSE '' END AS new_columns, {m} % 3 = 2 AS reordered FROM feed_{code}_dirty"""
        for code, y, m, cur in (("es", "anio", "mes", M.FEEDS["ES"][22][0]), ("it", "anno_riferimento", "mese_riferimento", M.FEEDS["IT"][22][0]))
    ),
)
oracle(
    "write_monthly", "feed_es feed_it",
    """SELECT printf('%d%02d', y, m) AS yyyymm, CASE WHEN y < 1998 THEN 'EUR' ELSE 'XXX' END AS moneda, COUNT(*) AS n
    FROM (SELECT anio AS y, mes AS m FROM feed_es UNION ALL SELECT anno_riferimento, mese_riferimento FROM feed_it)
    GROUP BY 1, 2""",
)
oracle(
    "append_rows", "dq_results",
    "SELECT source_system, check_status, 2 * COUNT(*) AS n FROM dq_results GROUP BY 1, 2",
)
oracle(
    "overwrite_slice", "shared",
    """SELECT source_country, 'APPROVED_COLUMN_AND_VALUE_MAPPING' AS mapping_status, risk_type, COUNT(*) AS n
    FROM shared WHERE source_country = 'ES' GROUP BY 1, 3 UNION ALL
    SELECT 'IT', 'APPROVED_COLUMN_MAPPING', risk_type, COUNT(*) FROM delivered WHERE source_country = 'IT' GROUP BY 3""",
)
oracle(
    "replace_by_key", "candidates",
    """SELECT source_table, local_column_name, CASE WHEN review_status = 'PENDING' THEN 'NEW' ELSE review_status END
    AS review_status, review_status AS source_system FROM candidates""",
)
oracle(
    "control_table_schema", "candidates", "SELECT candidate_id, source_system, review_status, mandatory_flag FROM candidates"
)


def _learned(asked: str, known: str) -> str:
    """CTEs up to ``best``: (out, name, family, shape, proposed, score); ``known`` says which columns teach which index."""
    begun = "SELECT name, substr('^' || t, i, {n}) AS f FROM tokens, range(1, 80) r(i) WHERE i <= length(t) + 2 - {n}"
    return f"""
    col AS (SELECT style, local_column_name AS name, COALESCE(global_column_name, 'NO_MATCH') AS target,
        CASE WHEN local_data_type IN ('int', 'bigint') THEN 'integer' WHEN local_data_type = 'double' THEN 'floating'
          WHEN local_data_type = 'timestamp' THEN 'time' ELSE 'string' END AS family,
        '#' || regexp_replace(regexp_replace(sample_value, '[\\p{{L}}]+', 'a', 'g'), '[0-9]+', '9', 'g') AS shape,
        source_system FROM styled_columns),
    tokens AS (SELECT DISTINCT name, unnest(string_split(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_')) AS t
      FROM (SELECT DISTINCT name FROM col)),
    bare AS (SELECT name, '^' || substr(t, 1, 1) || translate(substr(t, 2), 'aeiou', '') AS b FROM tokens),
    pieces AS ({begun.format(n=2)} UNION {begun.format(n=3)}
      UNION SELECT name, '~' || substr(b, i, 2) FROM bare, range(1, 80) r(i) WHERE i < length(b)),
    kinds AS (SELECT DISTINCT name, shape FROM col),
    ft AS MATERIALIZED (SELECT name, shape, f FROM kinds JOIN pieces USING (name) UNION ALL SELECT name, shape, shape FROM kinds),
    asked AS (SELECT DISTINCT {asked}),
    kn AS MATERIALIZED (SELECT DISTINCT {known}),
    sz AS (SELECT out, target, COUNT(*) AS n FROM kn GROUP BY ALL),
    fam AS (SELECT out, target, family, COUNT(*) AS same FROM kn GROUP BY ALL),
    ct AS (SELECT out, f, target, COUNT(*) AS c FROM kn JOIN ft USING (name, shape) GROUP BY ALL),
    rare AS (SELECT out, f, ln(1 + total / COUNT(*)) AS idf
      FROM ct JOIN (SELECT out, COUNT(*) AS total FROM sz GROUP BY ALL) USING (out) GROUP BY out, f, total),
    ix AS MATERIALIZED (SELECT out, f, target, idf, idf * c / n AS w FROM ct JOIN rare USING (out, f) JOIN sz USING (out, target)),
    lengths AS (SELECT out, target, sqrt(SUM(w * w)) AS length FROM ix GROUP BY ALL),
    own AS (SELECT out, name, shape, sqrt(SUM(idf * idf)) AS own,
        COUNT(idf) / COUNT(*) AS share FROM (SELECT DISTINCT out, name, shape FROM asked) JOIN ft USING (name, shape)
        LEFT JOIN rare USING (out, f) GROUP BY ALL),
    dots AS (SELECT out, name, family, shape, target, SUM(idf * w) AS dot FROM asked JOIN ft USING (name, shape)
      JOIN ix USING (out, f) GROUP BY ALL),
    best AS (SELECT out, name, family, shape, target AS proposed,
        ROUND(dot / (length * own) * share * ((COALESCE(same, 0) + 0.5) / (n + 1)), 6) AS score
      FROM dots JOIN lengths USING (out, target) JOIN own USING (out, name, shape) JOIN sz USING (out, target)
      LEFT JOIN fam USING (out, target, family)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY out, name, family, shape ORDER BY score DESC, target) = 1)"""


ORACLES["unseen_names"] = f"""WITH {_with(["styled_columns"])}, {_learned(
    "style AS out, name, family, shape FROM col",
    "o.style AS out, c.target, c.name, c.family, c.shape FROM col c JOIN (SELECT DISTINCT style FROM col) o ON o.style <> c.style",
)}
SELECT style, COUNT(*) AS n_columns, CAST(SUM(CASE WHEN COALESCE(proposed, 'NO_MATCH') = target THEN 1 ELSE 0 END) AS BIGINT) AS n_right,
  ROUND(SUM(CASE WHEN COALESCE(proposed, 'NO_MATCH') = target THEN 1 ELSE 0 END) / COUNT(*), 4) AS accuracy
FROM col LEFT JOIN best ON out = style AND best.name = col.name AND best.family = col.family AND best.shape = col.shape GROUP BY style"""
ORACLES["learned_mappings"] = f"""WITH {_with(["styled_columns"])}, {_learned(
    "1 AS out, name, family, shape FROM col WHERE style IN ('no vowels', 'three letters')",
    "1 AS out, target, name, family, shape FROM col WHERE style = 'plain'",
)}
SELECT source_system, col.name AS local_column_name, COALESCE(proposed, 'NO_MATCH') AS proposed, COALESCE(score, 0.0) AS score
FROM col LEFT JOIN best ON best.name = col.name AND best.family = col.family AND best.shape = col.shape
WHERE style IN ('no vowels', 'three letters')"""

# Stored parts: the same numbers as from the rows
for _part, _direct in {
    "parts_by_source": "kpi_by_source",
    "parts_all_dimensions": "kpi_all_dimensions",
    "parts_loss_ratio_last3m": "kpi_loss_ratio_last3m",
    "parts_top_channel": "kpi_top_channel",
    "merge_candidates_buckets": "merge_candidates",
    "sync_decisions_buckets": "sync_decisions",
    "publish_run": "harmonized_rows",
}.items():
    ORACLES[_part] = ORACLES[_direct]
oracle(
    "distinct_sketches", "shared",
    "SELECT source_country, COUNT(*) AS row_count, "
    + ", ".join(f"COUNT(DISTINCT {c}) AS distinct_{c}, TRUE AS near_{c}" for c in M.REQUIRED)
    + " FROM shared GROUP BY 1",
)

# Ordered lists
oracle(
    "status_listing", "candidates",
    """SELECT review_status, mandatory_flag, local_column_name, COUNT(*) AS repeats, CAST(SUM(COUNT(*)) OVER (PARTITION BY
    review_status, mandatory_flag ORDER BY local_column_name) - COUNT(*) + 1 AS BIGINT) AS position
    FROM candidates WHERE local_column_name IS NOT NULL GROUP BY 1, 2, 3""",
)
oracle(
    "value_prompts", "delivered allowed",
    f"""SELECT f.source_field, part, 'Give one allowed value for every local value of ''' || f.source_field
    || '''. Allowed: ' || (SELECT string_agg(allowed_value, ', ' ORDER BY allowed_value) FROM allowed a
      WHERE a.source_field = f.source_field) || '. Local: ' || string_agg(raw_value, ', ' ORDER BY raw_value)
    || '. Answer with one JSON object from local to allowed value, null where none is safe.' AS prompt
    FROM (SELECT source_field, raw_value, (ROW_NUMBER() OVER (PARTITION BY source_field ORDER BY raw_value) - 1) // 2 + 1 AS part
      FROM (SELECT DISTINCT source_field, raw_value FROM ({_FOUND}) WHERE source_field <> 'region')) f
    GROUP BY f.source_field, part""",
)

_SHOWN = "mandatory_flag DESC NULLS LAST, confidence DESC NULLS LAST, local_column_name NULLS FIRST, source_system NULLS FIRST"
oracle(
    "view_positions", "candidates",
    f"""SELECT source_system, local_column_name, mandatory_flag, confidence, ROW_NUMBER() OVER (ORDER BY {_SHOWN}) AS view_position
    FROM candidates WHERE review_status = 'PENDING'""",
)
oracle(
    "preview_rejected", "candidates",
    """SELECT source_system, local_column_name FROM candidates WHERE review_status = 'REJECTED'
    ORDER BY local_column_name LIMIT 5""",
)

# Case folding
oracle(
    "folded_scores", "cased_targets",
    """SELECT source_system, local_column_name, substr(local_column_name, 5)::BIGINT % 6 NOT IN (1, 4) AS correct
    FROM cased_targets""",
)

# Flows
_OLD = ", ".join(f"c.{n}" for n in ("source_system", "local_column_name"))
ORACLES["propose_run"] = f"""WITH proposed AS ({ORACLES['propose_feeds']}), candidates AS ({ansi('candidates')})
    SELECT source_system, local_column_name, proposed AS proposed_global_column_name, proposed_match_type, confidence,
    mandatory_flag, 'PENDING' AS review_status FROM proposed UNION ALL
    SELECT {_OLD}, c.proposed_global_column_name, c.proposed_match_type, c.confidence, c.mandatory_flag, c.review_status
    FROM candidates c"""
oracle(
    "dictionary_run", "mapping_dictionary key",
    """SELECT source_system, local_column_name, global_column_name, approved_by, mapping_version, active_flag
    FROM mapping_dictionary UNION ALL
    SELECT source_system, local_column_name, expected, 'reader', 'v1', TRUE FROM key WHERE expected IS NOT NULL""",
)
oracle("publish_checks", "shared", _dq_oracle(probes=False))
