"""Expectation, check, masking and metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import pii
from ..functions.text import SPECIAL_CHARACTERS
from ..operators import checks, metrics
from ..operators.expectations import Expectations
from ..operators.sets import name_issues
from ..operators.upsert import stamp_checked
from .nested import text
from .registry import query

_SPECIALS = SPECIAL_CHARACTERS.replace("'", "''")


def non_ascii_sql(c):
    return f"regexp_matches({c}, '[^\\x20-\\x7E]')"


def special_sql(c):
    return f"(length({c}) - length(translate({c}, '{_SPECIALS}', '')) > length({c}) * 0.4)"


@query("expectations_report", """
    WITH n AS (
        SELECT count(*) AS n, count(*) FILTER (o_custkey IS NULL) AS nulls, count(DISTINCT o_orderkey) AS keys,
               count(DISTINCT o_custkey) AS custs, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS outside FROM orders)
    SELECT 0 AS position, 'Column ''o_orderkey'' exists' AS assertion, TRUE AS success, '' AS details
    UNION ALL SELECT 1, 'Column ''o_comment'' exists', FALSE, ''
    UNION ALL SELECT 2, 'Column ''o_custkey'' is not null', nulls = 0, 'Null count: ' || nulls FROM n
    UNION ALL SELECT 3, 'Column ''o_orderkey'' values are unique', n = keys, 'Total: ' || n || ', Distinct: ' || keys FROM n
    UNION ALL SELECT 4, 'Column ''o_custkey'' values are unique', n = custs, 'Total: ' || n || ', Distinct: ' || custs FROM n
    UNION ALL SELECT 5, 'Column ''o_orderstatus'' values in [''F'', ''O'']', outside = 0, 'Invalid count: ' || outside FROM n
    UNION ALL SELECT 6, 'Row count between 1 and 10', n BETWEEN 1 AND 10, 'Actual count: ' || n FROM n
    UNION ALL SELECT 7, 'Cannot check nulls for ''o_comment'' - column missing', FALSE, ''
""")
def expectations_report(t):
    return (Expectations(t.orders).column_to_exist("o_orderkey").column_to_exist("o_comment").column_values_not_null("o_custkey")
            .column_values_unique("o_orderkey").column_values_unique("o_custkey").column_values_in_set("o_orderstatus", ["F", "O"])
            .row_count_between(1, 10).column_values_not_null("o_comment").report())


@query("dq_missing_unexpected", """
    WITH f AS (SELECT DISTINCT p_type AS c FROM part), e AS (SELECT unnest(['PROMO', 'SMALL', 'tax_id']) AS c)
    SELECT c AS "column", 'missing_column' AS issue FROM e WHERE c NOT IN (SELECT c FROM f)
    UNION ALL SELECT c, 'unexpected_column' FROM f WHERE c NOT IN (SELECT c FROM e)
""")
def dq_missing_unexpected(t):
    """Columns that a pivot of the parts by type would have, against the expected ones: the names come from the whole table."""
    return name_issues(t.part, "p_type", ("PROMO", "SMALL", "tax_id"))


def typed_as_text(t):
    kind = F.col("p_type")
    size, price = text("p_size"), F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    return t.part.select(
        "p_partkey", F.when(kind == "SMALL", F.concat(size, F.lit(".5"))).when(kind == "LARGE", F.concat(F.lit(" "), size)).otherwise(size).alias("size"),
        F.when(kind == "PROMO", "n/a").when(kind == "ECONOMY", F.concat(price, F.lit("f"))).otherwise(price).alias("price"),
        F.when(kind == "MEDIUM", "TRUE").when(kind == "SMALL", "yes").otherwise("0").alias("active"), "p_name", "p_size")


@query("dq_dtype", r"""
    SELECT CAST(p_partkey AS VARCHAR) AS row_id, 'size' AS "column", 'dtype_mismatch' AS issue, p_size || '.5' AS value FROM part WHERE p_type = 'SMALL'
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'price', 'dtype_mismatch', 'n/a' FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'price', 'dtype_mismatch', CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || 'f' FROM part WHERE p_type = 'ECONOMY'
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'active', 'dtype_mismatch', 'yes' FROM part WHERE p_type = 'SMALL'
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_name', 'dtype_mismatch', p_name FROM part
""")
def dq_dtype(t):
    df = typed_as_text(t)
    expected = {"size": "INT", "price": "decimal", "active": "boolean", "p_name": "array<string>", "p_size": "bigint", "gone": "int"}
    return checks.find_issues(df, checks.dtype_checks(df, expected), "p_partkey").drop("masked_value")


@query("dq_nulls", """
    SELECT CAST(doc_id AS VARCHAR) AS row_id, 'quality' AS "column", 'null_violation' AS issue, CAST(NULL AS VARCHAR) AS value
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'lang', 'null_violation', ' NaN ' FROM documents WHERE lang = 'de'
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'lang', 'null_violation', 'None' FROM documents WHERE lang = 'fr'
""")
def dq_nulls(t):
    lang = F.col("lang")
    df = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "quality", "toxic", F.when(lang == "de", " NaN ").when(lang == "fr", "None").otherwise(lang).alias("lang"))
    nullable = {"doc_id": False, "quality": False, "lang": False, "toxic": True}
    return checks.find_issues(df, checks.null_checks(df, nullable), "doc_id").drop("masked_value")


DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
CORRUPTION_SQL = "\n UNION ALL ".join(
    f"""SELECT CAST(doc_id AS VARCHAR) AS row_id, '{c}' AS "column", '{issue}' AS issue, md5(CAST({c} AS VARCHAR)) AS value FROM documents WHERE {test}"""
    for c in DOCUMENT_COLUMNS for issue, test in (("corrupted_non_ascii", non_ascii_sql(f"CAST({c} AS VARCHAR)")),
                                             ("corrupted_special_chars", special_sql(f"CAST({c} AS VARCHAR)"))))


@query("dq_corruption", CORRUPTION_SQL)
def dq_corruption(t):
    df = t.spread("documents")
    found = checks.find_issues(df, checks.corruption_checks(df, DOCUMENT_COLUMNS), "doc_id")
    return found.select("row_id", "column", "issue", F.md5("value").alias("value"))


@query("dq_corruption_words", f"""
    WITH words AS (SELECT page_id || '-' || i AS word_id, string_split(html, ' ')[i] AS word
                   FROM pages, unnest(range(1, len(string_split(html, ' ')) + 1)) AS u(i))
    SELECT word_id AS row_id, 'corrupted_non_ascii' AS issue, word AS value FROM words WHERE {non_ascii_sql('word')}
    UNION ALL SELECT word_id, 'corrupted_special_chars', word FROM words WHERE length(word) > 0 AND {special_sql('word')}
""")
def dq_corruption_words(t):
    words = t.spread("pages").select("page_id", F.posexplode(F.split("html", " ")).alias("i", "word"))
    df = words.select(F.concat_ws("-", "page_id", F.col("i") + 1).alias("word_id"), "word")
    found = checks.find_issues(df, checks.corruption_checks(df, ["word"]), "word_id")
    return found.select("row_id", "issue", "value")


@query("dq_patterns", r"""
    SELECT CAST(p_partkey AS VARCHAR) AS row_id, 'p_brand' AS "column", 'pattern_mismatch' AS issue, p_brand AS value
    FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]')
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_name', 'pattern_mismatch', p_name FROM part WHERE NOT regexp_full_match(p_name, '(red|blue) [a-z]+')
""")
def dq_patterns(t):
    df = t.part
    found = checks.pattern_checks(df, {"p_brand": "Brand#[0-9]", "p_name": "(red|blue) [a-z]+", "gone": "x"})
    return checks.find_issues(df, found, "p_partkey").drop("masked_value")


METRIC_COLUMNS = (*DOCUMENT_COLUMNS, "quality", "toxic")


def metrics_sql(columns, source, flagged):
    pct = "round_even(CAST({} AS DOUBLE) / count(*) * 100, 2)".format
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {pct(f'count({c})')} AS completeness_pct, {pct(f'count(DISTINCT {c})')} AS uniqueness_pct,
            {pct(f'(count(*) - {flagged.get(c, 0)})')} AS validity_pct FROM {source}""" for c in columns)


LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
TEXT_FLAGGED = f"count(*) FILTER ({non_ascii_sql('text')} OR {special_sql('text')})"


def labelled_documents(t):
    return t.spread("documents").join(t.labels, "doc_id", "left").select(*METRIC_COLUMNS)


@query("dq_metrics", metrics_sql(METRIC_COLUMNS, LABELLED, {"text": TEXT_FLAGGED}))
def dq_metrics(t):
    df = labelled_documents(t)
    issues = checks.find_issues(df, checks.corruption_checks(df, ["text"]), "doc_id")
    return metrics.quality_metrics(df, metrics.flagged_rows(issues), METRIC_COLUMNS)


@query("dq_metrics_fused", metrics_sql(METRIC_COLUMNS, LABELLED, {"text": TEXT_FLAGGED}))
def dq_metrics_fused(t):
    df = labelled_documents(t)
    return metrics.checked_metrics(df, checks.corruption_checks(df, ["text"]))


LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("dq_metrics_lineitem", metrics_sql(LINEITEM_COLUMNS, "lineitem", {}))
def dq_metrics_lineitem(t):
    df = t.spread("lineitem")
    return metrics.checked_metrics(df, checks.null_checks(df, {"l_orderkey": False}))


@query("dq_issue_counts", f"""
    WITH i AS ({CORRUPTION_SQL}), n AS (SELECT "column", issue, count(*) AS n FROM i GROUP BY "column", issue)
    SELECT "column", issue, n, CAST(sum(n) OVER (PARTITION BY "column") AS BIGINT) AS total_issues FROM n
""")
def dq_issue_counts(t):
    df = t.spread("documents")
    counts = metrics.issue_counts(checks.find_issues(df, checks.corruption_checks(df, DOCUMENT_COLUMNS), "doc_id"))
    return counts.join(metrics.column_totals(counts), "column")


_REPORT_METRICS = metrics_sql(DOCUMENT_COLUMNS, "documents", {
    c: f"count(*) FILTER ({non_ascii_sql(f'CAST({c} AS VARCHAR)')} OR {special_sql(f'CAST({c} AS VARCHAR)')})" for c in DOCUMENT_COLUMNS})


_REPORT_SQL = f"""
    WITH i AS ({CORRUPTION_SQL}), m AS ({_REPORT_METRICS})
    SELECT 'summary' AS section, CAST(NULL AS VARCHAR) AS "column", 'total_rows' AS item, CAST(count(*) AS DOUBLE) AS number FROM documents
    UNION ALL SELECT 'summary', NULL, 'total_issues', CAST(count(*) AS DOUBLE) FROM i
    UNION ALL SELECT 'issues_by_column', "column", issue, CAST(count(*) AS DOUBLE) FROM i GROUP BY "column", issue
    UNION ALL SELECT 'quality_metrics', "column", 'completeness_pct', completeness_pct FROM m
    UNION ALL SELECT 'quality_metrics', "column", 'uniqueness_pct', uniqueness_pct FROM m
    UNION ALL SELECT 'quality_metrics', "column", 'validity_pct', validity_pct FROM m
"""


@query("dq_report", _REPORT_SQL)
def dq_report(t):
    """Report straight from the checks: one scan."""
    df = t.spread("documents")
    return metrics.checked_report(df, checks.corruption_checks(df, DOCUMENT_COLUMNS))


@query("dq_report_from_issues", _REPORT_SQL)
def dq_report_from_issues(t):
    """The same report from a table of issues."""
    df = t.spread("documents")
    issues = checks.find_issues(df, checks.corruption_checks(df, DOCUMENT_COLUMNS), "doc_id")
    return metrics.quality_report(df, issues)


# --- masking -------------------------------------------------------------------------------------------------------------

_MASKS_SQL = {
    "email": "regexp_replace({c}, '([A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*(@.*)', '\\1****\\2', 'g')",
    "phone": "regexp_replace({c}, '(\\d{{2}})\\d+(\\d{{2}})', '\\1****\\2', 'g')",
    "credit_card": "array_to_string(list_transform(regexp_extract_all({c}, '[0-9]+|[^0-9]+'), lambda x: CASE WHEN "
                   "regexp_full_match(x, '[0-9]{{5,}}') THEN repeat('*', length(x) - 4) || right(x, 4) ELSE x END), '')",
    "ssn": "'***-**-' || right({c}, 4)",
    "passport": "left({c}, 1) || '****' || right({c}, 2)",
    "iban": "left({c}, 4) || '****' || right({c}, 4)",
    "ipv4": "'***.***.***.' || list_last(string_split({c}, '.'))",
    "ipv6": "'****:****:****:****:' || list_last(string_split({c}, ':'))",
    "dob": "'****-**-**'",
}


def kind_sql(c):
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{k}'" for k, p in pii.PII_PATTERNS.items()) + " END"


def mask_sql(c):
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN {_MASKS_SQL[k].format(c=c)}"
                              for k, p in pii.PII_PATTERNS.items()) + f" ELSE {c} END"


@query("pii_mask_documents", f"SELECT doc_id, {kind_sql('text')} AS kind, md5({mask_sql('text')}) AS masked FROM documents")
def pii_mask_documents(t):
    known = t.spread("documents").select("doc_id", "text", pii.pii_kind(F.col("text")).alias("kind"))
    return known.select("doc_id", "kind", F.md5(pii.mask_as(F.col("kind"), F.col("text"))).alias("masked"))


@query("pii_mask_conversations", f"""
    SELECT conv_id, turn, {mask_sql('role')} AS role, md5({mask_sql('text')}) AS text FROM conversations
""")
def pii_mask_conversations(t):
    masked = checks.mask_table(t.spread("conversations"), ["role", "text"])
    return masked.withColumn("text", F.md5("text"))


PERSON_SQL = """
    SELECT c_custkey AS id, c_name || '@mail.example.org' AS email, '+49' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
           '4111 ' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') || ' 12345 678' AS card,
           '123-45-' || right(lpad(CAST(c_custkey AS VARCHAR), 4, '0'), 4) AS ssn, 'K' || (1000000 + c_custkey) AS passport,
           'DE89' || upper(c_mktsegment) || '00X' AS iban, '10.0.' || c_nationkey || '.7' AS ip,
           '2001:db8:0:0:0:0:0:' || c_nationkey AS ipv6, '1990-01-02' AS dob, c_mktsegment AS segment FROM customer
"""
PERSON_COLUMNS = ("email", "phone", "card", "ssn", "passport", "iban", "ip", "ipv6", "dob", "segment")


def people(t):
    key = text("c_custkey")
    padded = F.lpad(key, 4, "0")
    return t.spread("customer").select(
        F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("@mail.example.org")).alias("email"),
        F.concat(F.lit("+49"), F.lpad(key, 10, "0")).alias("phone"), F.concat(F.lit("4111 "), padded, F.lit(" 12345 678")).alias("card"),
        F.concat(F.lit("123-45-"), F.right(padded, F.lit(4))).alias("ssn"), F.concat(F.lit("K"), F.col("c_custkey") + 1000000).alias("passport"),
        F.concat(F.lit("DE89"), F.upper("c_mktsegment"), F.lit("00X")).alias("iban"),
        F.concat(F.lit("10.0."), text("c_nationkey"), F.lit(".7")).alias("ip"),
        F.concat(F.lit("2001:db8:0:0:0:0:0:"), text("c_nationkey")).alias("ipv6"), F.lit("1990-01-02").alias("dob"),
        F.col("c_mktsegment").alias("segment"))


@query("pii_mask_people", f"SELECT id, {', '.join(f'{mask_sql(c)} AS {c}' for c in PERSON_COLUMNS)} FROM ({PERSON_SQL})")
def pii_mask_people(t):
    return checks.mask_table(people(t), PERSON_COLUMNS)


PII_ISSUES_SQL = f"WITH p AS ({PERSON_SQL}), m AS (" + " UNION ALL ".join(
    f"""SELECT CAST(id AS VARCHAR) AS row_id, '{c}' AS "column", 'pii_detected' AS issue, {c} AS value, {mask_sql(c)} AS masked_value FROM p"""
    for c in PERSON_COLUMNS) + ") SELECT * FROM m WHERE masked_value <> value"


@query("pii_issues", PII_ISSUES_SQL)
def pii_issues(t):
    df = people(t)
    return checks.find_issues(df, checks.pii_checks(df, PERSON_COLUMNS), "id")


@query("pii_first_issues", f"""
    SELECT row_id, "column", value, masked_value FROM ({PII_ISSUES_SQL})
    QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY CAST(row_id AS BIGINT)) <= 5
""")
def pii_first_issues(t):
    """Report sample: the first five findings of each column."""
    df = people(t)
    found = checks.first_issues(df, checks.pii_checks(df, PERSON_COLUMNS), "id")
    return found.select("row_id", "column", "value", "masked_value")


# --- catalog-driven checks -------------------------------------------------------------------------------------------------

STATE_SQL = """
    SELECT o_orderkey AS table_id, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS updated_at,
           CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN CAST(915148800 AS BIGINT) ELSE CAST(floor(epoch(o_orderdate)) AS BIGINT) END AS last_dq_checked
    FROM orders
"""


def table_state(t):
    updated = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    status = F.col("o_orderstatus")
    checked = F.when(status == "O", F.lit(915148800).cast("bigint")).when(status == "P", updated)
    return t.orders.select(F.col("o_orderkey").alias("table_id"), updated.alias("updated_at"), checked.alias("last_dq_checked"))


@query("dq_table_selection", f"SELECT table_id FROM ({STATE_SQL}) WHERE updated_at > last_dq_checked OR last_dq_checked IS NULL")
def dq_table_selection(t):
    return checks.tables_to_check(table_state(t)).select("table_id")


@query("dq_stamp_checked", f"""
    SELECT table_id, CASE WHEN updated_at > last_dq_checked OR last_dq_checked IS NULL THEN CAST(1700000000 AS BIGINT) ELSE last_dq_checked END
        AS last_dq_checked FROM ({STATE_SQL})
""")
def dq_stamp_checked(t):
    state = table_state(t)
    return stamp_checked(state, checks.tables_to_check(state), 1700000000).select("table_id", "last_dq_checked")


@query("table_metadata", """
    SELECT p_partkey AS table_id, p_brand AS name, lower(p_type) AS type_name, p_size > 10 AS nullable, FALSE AS pii FROM part
    UNION ALL SELECT p_partkey, p_name, 'string', TRUE, NULL FROM part
""")
def table_metadata(t):
    tables = t.part.select(F.col("p_partkey").alias("table_id"), F.to_json(F.array(
        F.struct(F.col("p_brand").alias("name"), F.lower("p_type").alias("type_name"), (F.col("p_size") > 10).alias("nullable"),
                 F.lit(False).alias("pii")),
        F.struct(F.col("p_name").alias("name"), F.lit("string").alias("type_name"), F.lit(True).alias("nullable"),
                 F.lit(None).cast("boolean").alias("pii")))).alias("metadata"))
    return checks.metadata_rows(tables, "table_id")


@query("dq_validate_table", f"""
    SELECT CAST(NULL AS VARCHAR) AS row_id, 'owner' AS "column", 'missing_column' AS issue
    UNION ALL SELECT NULL, 'source', 'unexpected_column'
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'lang', 'dtype_mismatch' FROM documents
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source', 'pattern_mismatch' FROM documents WHERE NOT regexp_full_match(source, 'src[0-9]')
    UNION ALL {" UNION ALL ".join(
        f"SELECT CAST(doc_id AS VARCHAR), '{c}', 'corrupted_non_ascii' FROM documents WHERE {non_ascii_sql(f'CAST({c} AS VARCHAR)')} "
        f"UNION ALL SELECT CAST(doc_id AS VARCHAR), '{c}', 'corrupted_special_chars' FROM documents WHERE {special_sql(f'CAST({c} AS VARCHAR)')}"
        for c in ("doc_id", "text", "lang", "source"))}
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'text', 'pii_detected' FROM documents WHERE {mask_sql('text')} <> text
""")
def dq_validate_table(t):
    """All checks of a table in one pass."""
    df = t.spread("documents").select("doc_id", "text", "lang", "source")
    rules = {"expected_schema": {"doc_id": "bigint", "text": "string", "lang": "int", "owner": "string"},
             "expected_columns": ["doc_id", "text", "lang", "owner"], "nullable": {"doc_id": False, "text": False}}
    found = checks.validate_table(df, rules, "doc_id", {"source": "src[0-9]"}, ["text", "lang", "source"])
    return found.select("row_id", "column", "issue")
