"""Rule-driven validation and repair queries over a customer contact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, rules
from ..operators.inference import SHAPES, infer_types
from ..operators.sets import union_all
from ..plans.quality import repair_table
from .nested import text
from .quality import non_ascii_sql, special_sql
from .registry import query

CONTACTS_SQL = """
    contacts AS (
        SELECT c_custkey AS id, CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < 0 THEN 'X' ELSE c_name END AS name,
               CASE c_mktsegment WHEN 'FURNITURE' THEN '+1' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') || ' ext'
                    WHEN 'BUILDING' THEN '(+49) ' || c_custkey ELSE '+49' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS phone,
               CAST(c_nationkey * 5 AS VARCHAR) || CASE WHEN c_mktsegment = 'MACHINERY' THEN ';' ELSE ', ' END || CAST(-c_nationkey * 8 AS VARCHAR) AS latlong,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'ftp://x' || c_custkey WHEN 'BUILDING' THEN 'shop' || c_custkey || '.com'
                    ELSE 'https://s' || c_custkey END AS url,
               CASE WHEN c_nationkey > 20 THEN 'no mail' ELSE 'c' || c_custkey || '@corp.example' END AS email,
               CASE WHEN c_nationkey = 3 THEN '1-2' ELSE CAST(CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR) END AS balance,
               c_mktsegment AS segment,
               CASE WHEN c_nationkey < 3 THEN '#!$%' || c_nationkey WHEN c_nationkey < 6 THEN 'Zürich ' || c_name ELSE 'note ' || c_name END AS remark,
               CASE WHEN c_nationkey < 8 THEN '2024-01-0' || (c_nationkey + 1) WHEN c_nationkey < 16 THEN '05-Mar-2024' ELSE 'soon' END AS since,
               CASE WHEN c_nationkey < 12 THEN 'Yes' WHEN c_nationkey < 20 THEN '0' ELSE 'maybe' END AS active,
               CASE WHEN c_nationkey < 12 THEN '1.5e3' WHEN c_nationkey < 20 THEN '-.5' ELSE '1.5f' END AS score
        FROM customer)
"""


def contacts(t):
    key, nation, segment, balance = text("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_acctbal")
    padded = F.lpad(key, 10, "0")
    lit, cat = F.lit, F.concat
    return t.spread("customer").select(
        F.col("c_custkey").alias("id"),
        F.when(balance < -500, None).when(balance < 0, "X").otherwise(F.col("c_name")).alias("name"),
        F.when(segment == "FURNITURE", cat(lit("+1"), padded, lit(" ext"))).when(segment == "BUILDING", cat(lit("(+49) "), key))
        .otherwise(cat(lit("+49"), padded)).alias("phone"),
        cat((nation * 5).cast("string"), F.when(segment == "MACHINERY", ";").otherwise(", "), (-nation * 8).cast("string")).alias("latlong"),
        F.when(segment == "HOUSEHOLD", cat(lit("ftp://x"), key)).when(segment == "BUILDING", cat(lit("shop"), key, lit(".com")))
        .otherwise(cat(lit("https://s"), key)).alias("url"),
        F.when(nation > 20, "no mail").otherwise(cat(lit("c"), key, lit("@corp.example"))).alias("email"),
        F.when(nation == 3, "1-2").otherwise(F.floor("c_acctbal").cast("int").cast("string")).alias("balance"),
        segment.alias("segment"),
        F.when(nation < 3, cat(lit("#!$%"), text("c_nationkey"))).when(nation < 6, cat(lit("Zürich "), "c_name"))
        .otherwise(cat(lit("note "), "c_name")).alias("remark"),
        F.when(nation < 8, cat(lit("2024-01-0"), (nation + 1).cast("string"))).when(nation < 16, "05-Mar-2024").otherwise("soon").alias("since"),
        F.when(nation < 12, "Yes").when(nation < 20, "0").otherwise("maybe").alias("active"),
        F.when(nation < 12, "1.5e3").when(nation < 20, "-.5").otherwise("1.5f").alias("score"))


CONFIG = {
    "validation_rules": {
        "name": {"data_type": "string", "required": True, "min_length": 3, "max_length": 18},
        "phone": {"data_type": "phone"},
        "latlong": {"data_type": "latlong"},
        "url": {"data_type": "url"},
        "email": {"data_type": "email"},
        "balance": {"data_type": "integer", "min_value": 0, "max_value": 9000},
        "segment": {"data_type": "string", "allowed_values": ["BUILDING", "FURNITURE", "MACHINERY"], "pattern": "[A-L]"},
        "remark": {"data_type": "string", "check_corruption": True, "min_length": 8},
        "since": {"data_type": "date"},
        "active": {"data_type": "boolean"},
        "score": {"data_type": "float"},
    },
    "fix_strategies": {
        "name": {"required_missing": "Unknown", "min_length_violation": "Short"},
        "balance": {"invalid_integer": "0"},
        "segment": {"invalid_value": "OTHER"},
        "remark": {"corrupt_characters": "cleaned"},
        "default": {"invalid_phone": "no phone", "min_length_violation": "too short", "invalid_string": "text", "invalid_integer": "-1"},
    },
    "custom_validation_rules": {
        "phone_formats": {"patterns": [r"\+?[1-9][0-9]{9,14}"]},
        "url_validation": {"accepted_domains": [".com", ".org"]},
        "coordinate_validation": {"latitude_range": [-90, 90], "longitude_range": [-180, 180]},
    },
    "quality_metrics": {"completeness": {"required_fields": ["name", "phone", "gone"]}},
}
FLAGS = {
    "name": {"required_missing": True, "min_length_violation": True},
    "phone": {"data_type_issue": True},
    "balance": {"data_type_issue": True, "max_value_violation": False},
    "segment": {"data_type_issue": True, "pattern_violation": True},
    "remark": {"corrupt_characters": True, "min_length_violation": True},
}

# (column, position, issue, test, replacement) of every rule; the replacement follows column, default, then type default.
TESTS = (
    ("name", 1, "required_missing", "name IS NULL", "Unknown"),
    ("name", 2, "min_length_violation", "length(name) < 3", "Short"),
    ("name", 3, "max_length_violation", "length(name) > 18", "text"),
    ("phone", 0, "invalid_phone", r"NOT regexp_full_match(phone, '\+?[1-9][0-9]{9,14}')", "no phone"),
    ("latlong", 0, "invalid_latlong", r"NOT coalesce(try_cast(nullif(regexp_extract(latlong, '^(-?[0-9.]+)\s*,\s*(-?[0-9.]+)$', 1), '') AS DOUBLE) "
     r"BETWEEN -90 AND 90 AND try_cast(nullif(regexp_extract(latlong, '^(-?[0-9.]+)\s*,\s*(-?[0-9.]+)$', 2), '') AS DOUBLE) BETWEEN -180 AND 180, FALSE)", "N/A"),
    ("url", 0, "invalid_url", "NOT (url LIKE 'http%' OR url LIKE '%.com%' OR url LIKE '%.org%')", "N/A"),
    ("email", 0, "invalid_email", "email NOT LIKE '%@%'", "N/A"),
    ("balance", 0, "invalid_integer", "NOT regexp_full_match(balance, '-?[0-9]+')", "0"),
    ("balance", 1, "min_value_violation", "try_cast(balance AS DOUBLE) < 0", "-1"),
    ("balance", 2, "max_value_violation", "try_cast(balance AS DOUBLE) > 9000", "-1"),
    ("segment", 1, "pattern_violation", "NOT regexp_matches(segment, '^[A-L]')", "text"),
    ("segment", 2, "invalid_value", "segment NOT IN ('BUILDING', 'FURNITURE', 'MACHINERY')", "OTHER"),
    ("remark", 1, "min_length_violation", "length(remark) < 8", "too short"),
    ("remark", 2, "corrupt_characters", non_ascii_sql("remark"), "cleaned"),
    ("remark", 3, "excessive_special_chars", special_sql("remark"), "text"),
    ("since", 0, "invalid_date", "since = 'soon'", "N/A"),
    ("active", 0, "invalid_boolean", "lower(active) NOT IN ('true', 'false', '1', '0', 'yes', 'no')", "N/A"),
    ("score", 0, "invalid_float", "score = '1.5f'", "N/A"),
)
OPEN = {("name", "required_missing"), ("name", "min_length_violation"), ("phone", "invalid_phone"), ("balance", "invalid_integer"),
        ("balance", "min_value_violation"), ("segment", "invalid_value"), ("segment", "pattern_violation"),
        ("remark", "corrupt_characters"), ("remark", "min_length_violation"), ("remark", "excessive_special_chars")}
COLUMNS = tuple(CONFIG["validation_rules"])

ISSUES_SQL = "issues AS (" + " UNION ALL ".join(
    f"""SELECT CAST(id AS VARCHAR) AS row_id, '{c}' AS "column", {o} AS ord, '{i}' AS issue, {c} AS value, '{r}' AS new_value,
        {str((c, i) in OPEN).upper()} AS open FROM contacts WHERE {test}""" for c, o, i, test, r in TESTS) + ")"


@query("rule_issues", f"""WITH {CONTACTS_SQL}, {ISSUES_SQL} SELECT row_id, "column", ord, issue, value FROM issues""")
def rule_issues(t):
    return rules.analyze(contacts(t), rules.RuleSet(CONFIG), "id")


@query("rule_corrupted", rf"""
    WITH {CONTACTS_SQL}
    SELECT id, name, CASE WHEN {TESTS[3][3]} THEN 'corrupted data' ELSE phone END AS phone,
           CASE WHEN {TESTS[4][3]} THEN 'corrupted data' ELSE latlong END AS latlong,
           CASE WHEN {TESTS[5][3]} THEN 'corrupted data' ELSE url END AS url,
           CASE WHEN {TESTS[6][3]} THEN 'corrupted data' ELSE email END AS email, balance,
           CASE WHEN {TESTS[10][3]} THEN 'corrupted data' ELSE segment END AS segment,
           CASE WHEN {TESTS[13][3]} OR {TESTS[14][3]} THEN 'corrupted data' ELSE remark END AS remark
    FROM contacts
""")
def rule_corrupted(t):
    return rules.replace_corrupted(contacts(t), rules.RuleSet(CONFIG)).drop("since", "active", "score")


def _fixed_sql(c):
    steps = [(test, r) for column, _, i, test, r in TESTS if column == c and (c, i) in OPEN]
    return "CASE " + " ".join(f"WHEN {test} THEN '{r}'" for test, r in reversed(steps)) + f" ELSE {c} END AS {c}" if steps else c


@query("rule_fix", f"WITH {CONTACTS_SQL} SELECT id, {', '.join(_fixed_sql(c) for c in COLUMNS)} FROM contacts")
def rule_fix(t):
    return rules.repair(contacts(t), rules.RuleSet(CONFIG), FLAGS)


@query("rule_fix_log", f"""
    WITH {CONTACTS_SQL}, {ISSUES_SQL}
    SELECT row_id, "column", ord, issue, new_value,
           CASE WHEN row_number() OVER w = 1 THEN value ELSE lag(new_value) OVER w END AS old_value
    FROM issues WHERE open WINDOW w AS (PARTITION BY row_id, "column" ORDER BY ord)
""")
def rule_fix_log(t):
    return rules.repair_log(contacts(t), rules.RuleSet(CONFIG), "id", FLAGS)


@query("rule_analysis", f"""
    WITH {CONTACTS_SQL}, {ISSUES_SQL}, n AS (SELECT "column", issue, count(*) AS n FROM issues GROUP BY "column", issue),
    listing AS (SELECT unnest({list(COLUMNS)}) AS "column")
    SELECT "column", issue, coalesce(n, 0) AS n, CAST(coalesce(sum(n) OVER (PARTITION BY "column"), 0) AS BIGINT) AS total_issues
    FROM listing LEFT JOIN n USING ("column")
""")
def rule_analysis(t):
    config = rules.RuleSet(CONFIG)
    return rules.column_analysis(rules.analyze(contacts(t), config, "id"), config)


@query("rule_outcome", f"""
    WITH {CONTACTS_SQL}, {ISSUES_SQL}
    SELECT count(*) FILTER (open) || ' issues were fixed across ' || count(DISTINCT "column") || ' columns.' AS outcome FROM issues
""")
def rule_outcome(t):
    config, df = rules.RuleSet(CONFIG), contacts(t)
    return rules.outcome(rules.analyze(df, config, "id"), rules.repair_log(df, config, "id", FLAGS))


@query("rule_completeness", f"""
    WITH {CONTACTS_SQL}
    SELECT 'name' AS "column", CAST(count(name) AS DOUBLE) / count(*) * 100 AS completeness FROM contacts
    UNION ALL SELECT 'phone', CAST(count(phone) AS DOUBLE) / count(*) * 100 FROM contacts
""")
def rule_completeness(t):
    return rules.required_completeness(contacts(t), rules.RuleSet(CONFIG))


@query("rule_synthesis", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{k}' AS data_type, TRUE AS required, TRUE AS check_corruption, 3 AS min_length,
        max(length({c})) AS max_length FROM documents""" for c, k in (("lang", "string"), ("source", "string"), ("text", "string"))))
def rule_synthesis(t):
    """Rules of the text columns of a whole table, as rows."""
    return rules.rule_rows(infer_types(t.documents, ("lang", "source", "text")), required=True)


#: Tables with columns of whole numbers, texts and JSON; texts of other numbers and of times differ between the engines.
TYPED_TABLES = {"documents": ("doc_id", "text", "lang", "source", "n_chars"), "orders": ("o_orderkey", "o_custkey", "o_orderstatus"),
                "events": ("event_id", "user_id", "event_type", "props"), "labels": ("doc_id", "quality", "toxic")}


def _inferred_sql(table, column):
    full = lambda shape: f"count(*) FILTER (regexp_matches(v, '{shape}')) = count(v)"
    cases = " ".join(f"WHEN {full(shape)} THEN '{name}'" for name, shape in SHAPES)
    return f"""SELECT '{table}' AS table_name, '{column}' AS "column", CASE WHEN count(v) = 0 THEN 'string' {cases} ELSE 'string' END AS data_type,
        count(v) = count(*) AS required, TRUE AS check_corruption, 3 AS min_length, max(length(v)) AS max_length
        FROM (SELECT CAST({column} AS VARCHAR) AS v FROM (SELECT * FROM {table}))"""


@query("rules_from_types", " UNION ALL ".join(
    _inferred_sql(table, column) for table, columns in TYPED_TABLES.items() for column in columns))
def rules_from_types(t):
    """Rules whose types are found in the data of whole tables, every value counted."""
    found = [rules.rule_rows(infer_types(getattr(t, table), columns)).select(F.lit(table).alias("table_name"), "*") for table, columns in TYPED_TABLES.items()]
    return union_all(found)


@query("longest_text", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", max(length(CAST({c} AS VARCHAR))) AS max_length FROM pages""" for c in ("page_id", "url", "html")))
def longest_text(t):
    return metrics.longest_text(t.pages, ("page_id", "url", "html"))


@query("rule_run_outcome", f"""
    WITH {CONTACTS_SQL.replace('contacts AS', 'raw_contacts AS')}, contacts AS (
        SELECT * REPLACE (CASE WHEN {TESTS[3][3]} THEN 'corrupted data' ELSE phone END AS phone,
           CASE WHEN {TESTS[4][3]} THEN 'corrupted data' ELSE latlong END AS latlong,
           CASE WHEN {TESTS[5][3]} THEN 'corrupted data' ELSE url END AS url,
           CASE WHEN {TESTS[6][3]} THEN 'corrupted data' ELSE email END AS email,
           CASE WHEN {TESTS[10][3]} THEN 'corrupted data' ELSE segment END AS segment,
           CASE WHEN {TESTS[13][3]} OR {TESTS[14][3]} THEN 'corrupted data' ELSE remark END AS remark) FROM raw_contacts), {ISSUES_SQL}
    SELECT "column", issue, count(*) AS n FROM issues GROUP BY "column", issue
""")
def rule_run_outcome(t):
    """The whole rule run: corrupted values are replaced first and judged as the replacement text."""
    return repair_table(contacts(t), CONFIG, "id", FLAGS)["summary"]
