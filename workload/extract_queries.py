"""Queries over documents made from the tables, and their SQL.

The SQL never sees XML: it states, from the base tables, what each document's rule
in ``xml_docs`` implies for the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.operators.issues import issues_table
from recordloom.operators.profile import issues_by, run_summary, top_issue_signatures
from recordloom.operators.tables import judge_documents, table_from_documents
from recordloom.plans.extract import extract_tables
from recordloom.schemas import CHILD_TABLES, table_schema
from recordloom.session import materialize, shared_folder
from recordloom.sinks.tables import register_tables, write_table
from recordloom.sources.documents import (
    attach_content,
    resolve_listed_paths,
    select_docs_containing,
)
from workload.xml_docs import build_xml

# What the XML parser says about a broken document is its own business.
_OWN_MESSAGE = "^(Missing|Unhandled|Multiple|No such|Creator has|Contributor has)"


def without_parser_text(df: DataFrame, column: str) -> DataFrame:
    own = F.col(column).rlike(_OWN_MESSAGE)
    return df.withColumn(
        column, F.when(F.col(column).isNotNull() & ~own, F.lit("malformed")).otherwise(F.col(column))
    )


def _table(name: str):
    return lambda spark, sf: table_from_documents(build_xml(spark, sf), name)


def records(spark: SparkSession, sf: str) -> DataFrame:
    return without_parser_text(table_from_documents(build_xml(spark, sf), "records"), "parse_error")


def records_strict(spark: SparkSession, sf: str) -> DataFrame:
    rows = table_from_documents(build_xml(spark, sf), "records", strict=True)
    return without_parser_text(rows, "parse_error").select(
        "record_id", "source_xml_path", "primary_title", "creator_count", "parse_ok", "parse_error"
    )


def error_records(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).where(~F.col("parse_ok"))


def issues(spark: SparkSession, sf: str, strict: bool = False) -> DataFrame:
    rows = table_from_documents(build_xml(spark, sf), "issues", strict)
    return without_parser_text(rows, "message").drop("timestamp_utc")


def issues_strict(spark: SparkSession, sf: str) -> DataFrame:
    return issues(spark, sf, strict=True)


def issue_counts_by_severity(spark: SparkSession, sf: str) -> DataFrame:
    return issues_by(issues(spark, sf), "severity")


def issue_counts_by_code(spark: SparkSession, sf: str) -> DataFrame:
    return issues_by(issues(spark, sf), "code")


def document_issue_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return top_issue_signatures(issues(spark, sf))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """The run summary, its maps and its list as JSON text."""
    judged = materialize(judge_documents(build_xml(spark, sf)).select(
        "path", "file_name", "warnings", "error_code", "error_message"
    ))
    found = without_parser_text(issues_table(judged), "message")
    one = run_summary(judged, found)
    return one.select(
        "processed_files",
        "fatal_parse_errors",
        F.to_json("issue_counts_by_severity").alias("issue_counts_by_severity"),
        F.to_json("issue_counts_by_code").alias("issue_counts_by_code"),
        F.array_join(
            F.transform(
                "top_issue_signatures",
                lambda t: F.concat(t["count"].cast("string"), F.lit(" "), t["signature"]),
            ),
            "\n",
        ).alias("top_issue_signatures"),
    )


def sql_example(spark: SparkSession, sf: str) -> DataFrame:
    register_tables({"records": table_from_documents(build_xml(spark, sf), "records")})
    return spark.sql(
        """SELECT record_id, identifier, primary_title, publication_year, version
           FROM records WHERE version IS NOT NULL ORDER BY record_id LIMIT 20"""
    )


def star_join(spark: SparkSession, sf: str) -> DataFrame:
    """Creators per kind of resource and year: a child table joined to its records."""
    _, tables = extract_tables(build_xml(spark, sf), tables=["records", "creators"])
    joined = tables["records"].join(tables["creators"], "record_id")
    return joined.groupBy("resource_type_general", "publication_year").agg(
        F.count("*").alias("creator_rows"),
        F.count_if(F.col("affiliation_name").isNotNull()).alias("affiliated_rows"),
        F.count_if(F.col("affiliation_order") == 1).alias("persons"),
    )


def star_join_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The same in SQL over saved tables of a database, bucketed by record id."""
    _, tables = extract_tables(build_xml(spark, sf), tables=["records", "creators"])
    database = f"extract_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}'")
    register_tables(tables, database, buckets=8)
    return spark.sql(f"""
SELECT resource_type_general, publication_year, count(*) AS creator_rows, count(affiliation_name) AS affiliated_rows,
       count_if(affiliation_order = 1) AS persons
FROM {database}.records JOIN {database}.creators USING (record_id) GROUP BY ALL""")


def select_docs(spark: SparkSession, sf: str) -> DataFrame:
    """File names of the documents that carry the literal type tag."""
    tag = '<resourceType resourceTypeGeneral="Dataset">'
    return select_docs_containing(build_xml(spark, sf), tag).select("file_name")


def _listed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A list with relative, absolute, repeated, blank and absent entries, with contents."""
    k = F.col("o_orderkey")
    lines = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.explode(
            F.when(k % 10 == 0, F.array(F.lit("  "), F.concat(F.lit("/xml/"), k, F.lit(".xml "))))
            .when(k % 10 == 1, F.array(F.concat(F.lit("./"), k, F.lit(".xml"))))
            .when(k % 10 == 2, F.array_repeat(F.concat(k, F.lit(".xml")), 2))
            .otherwise(F.array(F.concat(k, F.lit(".xml"))))
        ).alias("value")
    )
    return attach_content(resolve_listed_paths(lines, "/xml"), build_xml(spark, sf))


def missing_files(spark: SparkSession, sf: str) -> DataFrame:
    return _listed_documents(spark, sf).select(
        "path", "file_name", F.col("content").isNotNull().alias("found")
    )


def missing_file_issues(spark: SparkSession, sf: str) -> DataFrame:
    found = table_from_documents(_listed_documents(spark, sf), "issues")
    return found.where(F.col("code") == "MISSING_INPUT_FILE").drop("timestamp_utc")


def _written_titles(spark: SparkSession, sf: str, file_format: str) -> DataFrame:
    folder = shared_folder(spark)
    rows = table_from_documents(build_xml(spark, sf), "titles")
    write_table(rows, folder, file_format, max_records_per_file=100_000)
    source = "json" if file_format == "jsonl" else file_format
    return spark.read.schema(table_schema("titles")).format(source).load(folder)


def write_read_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return _written_titles(spark, sf, "parquet")


def write_read_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    return _written_titles(spark, sf, "jsonl")


QUERIES = {
    "records": records,
    "records_strict": records_strict,
    "error_records": error_records,
    **{name: _table(name) for name in CHILD_TABLES},
    "issues": issues,
    "issues_strict": issues_strict,
    "issue_counts_by_severity": issue_counts_by_severity,
    "issue_counts_by_code": issue_counts_by_code,
    "document_issue_signatures": document_issue_signatures,
    "run_summary": summary,
    "sql_example": sql_example,
    "star_join": star_join,
    "star_join_saved": star_join_saved,
    "select_docs_containing": select_docs,
    "missing_files": missing_files,
    "missing_file_issues": missing_file_issues,
    "write_read_parquet": write_read_parquet,
    "write_read_jsonl": write_read_jsonl,
}

# One row per document, then those that can be read.
_DOCS = """
WITH d AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS order_date,
         o_orderpriority AS priority, coalesce(c_name, '') AS customer,
         coalesce(c_mktsegment, '') AS segment, coalesce(n_name, '') AS nation,
         CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey || '.xml'
              ELSE 'doc-' || o_orderkey || '.xml' END AS file_name,
         o_orderkey % 97 = 0 AS malformed,
         o_orderkey % 97 <> 0 AND o_orderkey % 101 = 0 AS no_resource
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
              LEFT JOIN nation ON c_nationkey = n_nationkey
), ok AS (
  SELECT *, CAST(k AS VARCHAR) AS record_id, '/xml/' || file_name AS source_xml_path
  FROM d WHERE NOT malformed AND NOT no_resource
)"""

_RECORDS = _DOCS + """, r AS (
  SELECT *, NOT malformed AND NOT no_resource AS good FROM d
), recs AS (
SELECT CASE WHEN good OR k % 3 = 2 THEN CAST(k AS VARCHAR) END AS record_id,
       '/xml/' || file_name AS source_xml_path, file_name AS source_file_name,
       CASE WHEN good THEN '4.3' END AS schema_version,
       CASE WHEN good THEN 'X.Y' END AS datacentre_symbol,
       CASE WHEN good THEN '10.1/' || k END AS identifier,
       CASE WHEN good THEN 'DOI' END AS identifier_type,
       CASE WHEN good AND k % 3 = 0 THEN 'oai:x.example:' || (k + 1000000)
            WHEN good AND k % 3 = 1 THEN 'oai:x.example:' || k END AS oai_identifier,
       CASE WHEN good AND k % 3 = 0 THEN 'https://x.example/records/' || k
            WHEN good AND k % 3 = 1 THEN 'https://x.example/records/' || k || '/files' END AS record_url,
       CASE WHEN good THEN nation || ' Press' END AS publisher,
       CASE WHEN good AND k % 7 <> 0 THEN CAST(year(order_date) AS BIGINT) END AS publication_year,
       CASE WHEN good AND k % 2 = 1 THEN 'v' || (k % 10) END AS version,
       CASE WHEN good THEN 'Data of ' || status END AS resource_type,
       CASE WHEN good THEN CASE WHEN k % 2 = 0 THEN 'Dataset' ELSE 'Text' END END AS resource_type_general,
       CASE WHEN good THEN CASE WHEN k % 5 = 0 THEN strftime(order_date, '%Y-%m')
                                ELSE strftime(order_date, '%Y-%m-%d') END END AS issued_date_raw,
       CASE WHEN good AND k % 5 <> 0 THEN order_date END AS issued_date,
       CASE WHEN good AND k % 3 <> 0
            THEN strftime(order_date + CAST(k % 30 AS INTEGER), '%Y-%m-%d') END AS updated_date_raw,
       CASE WHEN good AND k % 3 <> 0 THEN order_date + CAST(k % 30 AS INTEGER) END AS updated_date,
       CASE WHEN good THEN priority || ' order ' || k END AS primary_title,
       CASE WHEN good THEN 2 - k % 2 ELSE 0 END AS title_count,
       CAST(CASE WHEN good THEN 1 ELSE 0 END AS BIGINT) AS description_count,
       CASE WHEN good THEN k % 4 ELSE 0 END AS creator_count,
       CAST(CASE WHEN good AND k % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS contributor_count,
       CASE WHEN good THEN k % 5 ELSE 0 END AS subject_count,
       CASE WHEN good THEN (k + 1) % 3 ELSE 0 END AS related_identifier_count,
       CAST(CASE WHEN good THEN 2 ELSE 0 END AS BIGINT) AS rights_count,
       CAST(CASE WHEN good AND k % 3 < 2 THEN 2 ELSE 0 END AS BIGINT) AS alternate_identifier_count,
       CASE WHEN good THEN 'info:eu-repo/semantics/'
            || CASE WHEN status = 'F' THEN 'openAccess' ELSE 'restrictedAccess' END END AS access_rights_uri,
       CASE WHEN good THEN CASE WHEN status = 'F' THEN 'openAccess' ELSE 'restrictedAccess' END END
            AS access_rights_label,
       good AS parse_ok,
       CASE WHEN malformed THEN 'malformed'
            WHEN no_resource THEN 'Missing /oai_datacite/payload/resource element' END AS parse_error
FROM r)"""

_TITLES = _DOCS + """
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS title_order,
       priority || ' order ' || k AS title_text, CAST(NULL AS VARCHAR) AS title_type,
       CASE WHEN k % 6 = 0 THEN 'en' END AS xml_lang
FROM ok
UNION ALL
SELECT record_id, source_xml_path, 2, 'status ' || status || ' <b>', 'Subtitle', NULL
FROM ok WHERE k % 2 = 0"""

_CREATOR_ROWS = _DOCS + """, person AS (
  SELECT ok.*, i, (k + i) % 4 AS ids, (k + i) % 3 AS affs
  FROM ok, unnest(range(1, k % 4 + 1)) AS t(i)
), creator_rows AS (
SELECT record_id, source_xml_path, i AS creator_order, a AS affiliation_order,
       customer || ' / ' || i AS creator_name,
       CASE WHEN i % 2 = 1 THEN 'Organizational' ELSE 'Personal' END AS creator_name_type,
       CASE WHEN i % 2 = 0 THEN 'G' || i END AS given_name,
       CASE WHEN i % 2 = 0 THEN segment END AS family_name,
       CASE WHEN ids > 0 THEN 'ID-' || k || '-' || i || '-1' END AS name_identifier,
       CASE WHEN ids > 0 THEN 'ORCID' END AS name_identifier_scheme,
       CAST(NULL AS VARCHAR) AS name_identifier_scheme_uri,
       CASE WHEN ids > 0 THEN 'https://orcid.example' END AS scheme_uri,
       CASE WHEN affs > 0 THEN 'Dept ' || a || ' of ' || nation END AS affiliation_name,
       CASE WHEN affs > 0 AND a = 1 THEN 'ror:' || k END AS affiliation_identifier,
       CASE WHEN affs > 0 AND a = 1 THEN 'ROR' END AS affiliation_identifier_scheme
FROM person, unnest(range(1, greatest(affs, 1) + 1)) AS u(a))"""

# Attributes that are not known: remainder of the document, element, place in the reading
# order, further condition, whether the record's id is known yet, and context.
_EXTRAS = [
    (1, "identifier", 3.2, "true", False, "'/resource/identifier'"),
    (2, "alternateIdentifier", 3.5, "k % 3 < 2", False, "'/resource/alternateIdentifiers/alternateIdentifier[1]'"),
    (3, "creatorName", 10.5, "k % 4 > 0", True, "'/resource/creators/creator[1]/creatorName'"),
    (4, "nameIdentifier", 11.5, "k % 4 > 0 AND (k + 1) % 4 > 0", True, "'/resource/creators/creator[1]/nameIdentifier[1]'"),
    (5, "affiliation", 11.7, "k % 4 > 0 AND (k + 1) % 3 > 0", True, "'/resource/creators/creator[1]/affiliation[1]'"),
    (6, "contributor", 99, "k % 4 = 0", True, "'/resource/contributors/contributor[1]'"),
    (7, "contributorName", 100.5, "k % 4 = 0", True, "'/resource/contributors/contributor[1]/contributorName'"),
    (8, "subject", 200, "k % 5 > 0", True, "'/resource/subjects/subject[1]'"),
    (9, "date", 210, "true", True, "'/resource/dates/date[' || CASE WHEN k % 11 = 0 THEN 2 ELSE 1 END || ']'"),
    (10, "resourceType", 220, "true", True, "'/resource/resourceType'"),
    (11, "relatedIdentifier", 230, "(k + 1) % 3 > 0", True, "'/resource/relatedIdentifiers/relatedIdentifier[1]'"),
    (12, "rights", 240, "true", True, "'/resource/rightsList/rights[1]'"),
    (13, "description", 250, "true", True, "'/resource/descriptions/description[1]'"),
]


def _extra_warnings() -> str:
    parts = []
    for n, element, place, condition, with_id, context in _EXTRAS:
        message = f"'Unhandled attribute ''extra'' on element ''{element}'''"
        parts.append(f"""
  UNION ALL
  SELECT k, file_name, {place}, 'UNHANDLED_ATTRIBUTE', {message}, {message},
         {'record_id' if with_id else 'NULL'}, {context}
  FROM ok WHERE k % 43 = {n} AND {condition}""")
    return "".join(parts)


# Every warning with its place in the reading order of its document.
_WARNINGS = _DOCS + """, w AS (
  SELECT k, file_name, CAST(1 AS DOUBLE) AS seq, 'UNHANDLED_ROOT_CHILD' AS code,
         'Unhandled root child element ''oaiNote''' AS message,
         'Unhandled root child element ''oaiNote''' AS strict_message,
         CAST(NULL AS VARCHAR) AS record_id, '/oai_datacite' AS context
  FROM d WHERE NOT malformed AND k % 17 = 0
  UNION ALL
  SELECT k, file_name, 2, 'UNHANDLED_RESOURCE_CHILD', 'Unhandled resource child element ''language''',
         'Unhandled resource child element ''language''', NULL, '/oai_datacite/payload/resource'
  FROM ok WHERE k % 10 = 0
  UNION ALL
  SELECT k, file_name, 3, 'UNHANDLED_RESOURCE_CHILD',
         'Unhandled resource child element ''fundingReferences''',
         'Unhandled resource child element ''fundingReferences''', NULL, '/oai_datacite/payload/resource'
  FROM ok WHERE k % 25 = 0
  UNION ALL
  SELECT k, file_name, 4, 'UNHANDLED_ATTRIBUTE', 'Unhandled attribute ''extra'' on element ''title''',
         'Unhandled attribute ''extra'' on element ''title''', record_id, '/resource/titles/title[1]'
  FROM ok WHERE k % 13 = 0
  UNION ALL
  SELECT k, file_name, 10, 'UNHANDLED_CREATOR_CHILD', 'Unhandled creator child element ''note''',
         'Unhandled creator child element ''note''', record_id, '/resource/creators/creator[1]'
  FROM ok WHERE k % 19 = 0 AND k % 4 > 0
  UNION ALL
  SELECT k, file_name, 10 * i + 1, 'MULTIPLE_NAME_IDENTIFIERS',
         'Creator has ' || ((k + i) % 4)
           || ' nameIdentifier elements; only the first is mapped into creators table',
         'Multiple creator nameIdentifier elements', record_id, '/resource/creators/creator[' || i || ']'
  FROM ok, unnest(range(1, k % 4 + 1)) AS t(i) WHERE (k + i) % 4 > 1
  UNION ALL
  SELECT k, file_name, 100, 'UNHANDLED_CONTRIBUTOR_CHILD', 'Unhandled contributor child element ''role''',
         'Unhandled contributor child element ''role''', record_id, '/resource/contributors/contributor[1]'
  FROM ok WHERE k % 4 = 0 AND k % 23 = 0
  UNION ALL
  SELECT k, file_name, 101, 'MULTIPLE_NAME_IDENTIFIERS',
         'Contributor has 2 nameIdentifier elements; only the first is mapped into contributors table',
         'Multiple contributor nameIdentifier elements', record_id, '/resource/contributors/contributor[1]'
  FROM ok WHERE k % 8 = 0""" + _extra_warnings() + ")"

_ISSUES = _WARNINGS + """, found AS (
  SELECT 'WARNING' AS severity, code, message, '/xml/' || file_name AS source_xml_path,
         file_name AS source_file_name, record_id, context FROM w
  UNION ALL
  SELECT 'ERROR', 'PARSE_EXCEPTION',
         CASE WHEN malformed THEN 'malformed'
              ELSE 'Missing /oai_datacite/payload/resource element' END,
         '/xml/' || file_name, file_name, NULL, 'parse_record_file'
  FROM d WHERE malformed OR no_resource
)"""

_FIRST_WARNING = _WARNINGS + """, first_w AS (
  SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1
)"""

_LISTED = _DOCS + """, entries AS (
  SELECT o_orderkey AS k, unnest(CASE WHEN o_orderkey % 10 = 2 THEN [1, 2] ELSE [1] END) AS copy
  FROM orders
), listed AS (
  SELECT '/xml/' || k || '.xml' AS path, k || '.xml' AS file_name, k % 3 = 2 AS found FROM entries
)"""

def summary_sql(signatures: str = "", top: int = 50, more: str = "") -> str:
    """The summary row; ``signatures`` says which issues the list of signatures is about."""
    return _ISSUES + f""", sev AS (
  SELECT severity, count(*) AS n FROM found GROUP BY severity
), codes AS (SELECT code, count(*) AS n FROM found GROUP BY code
), sigs AS (
  SELECT code || ': ' || message AS signature, count(*) AS n FROM found {signatures}
  GROUP BY ALL ORDER BY n DESC, signature LIMIT {top}
)
SELECT (SELECT count(*) FROM d) AS processed_files,
       (SELECT count(*) FROM d WHERE malformed OR no_resource) AS fatal_parse_errors,
       (SELECT '{{' || string_agg('"' || severity || '":' || n, ',' ORDER BY severity) || '}}' FROM sev)
         AS issue_counts_by_severity,
       (SELECT '{{' || string_agg('"' || code || '":' || n, ',' ORDER BY code) || '}}' FROM codes)
         AS issue_counts_by_code,
       (SELECT string_agg(n || ' ' || signature, chr(10) ORDER BY n DESC, signature) FROM sigs)
         AS top_issue_signatures{more}"""


_STAR_JOIN = _CREATOR_ROWS + """
SELECT CASE WHEN k % 2 = 0 THEN 'Dataset' ELSE 'Text' END AS resource_type_general,
       CASE WHEN k % 7 <> 0 THEN CAST(year(order_date) AS BIGINT) END AS publication_year,
       count(*) AS creator_rows,
       count(affiliation_name) AS affiliated_rows,
       count(*) FILTER (WHERE affiliation_order = 1) AS persons
FROM ok JOIN creator_rows USING (record_id) GROUP BY ALL"""

ORACLES = {
    "records": _RECORDS + " SELECT * FROM recs",
    "error_records": _RECORDS + " SELECT * FROM recs WHERE NOT parse_ok",
    "records_strict": _FIRST_WARNING + """
SELECT CASE WHEN good OR k % 3 = 2 THEN CAST(k AS VARCHAR) END AS record_id,
       '/xml/' || file_name AS source_xml_path,
       CASE WHEN good THEN priority || ' order ' || k END AS primary_title,
       CASE WHEN good THEN k % 4 ELSE 0 END AS creator_count,
       good AS parse_ok,
       CASE WHEN malformed THEN 'malformed'
            WHEN strict_message IS NOT NULL THEN strict_message
            WHEN no_resource THEN 'Missing /oai_datacite/payload/resource element' END AS parse_error
FROM (SELECT d.*, first_w.strict_message,
             NOT malformed AND NOT no_resource AND first_w.k IS NULL AS good
      FROM d LEFT JOIN first_w ON d.k = first_w.k)""",
    "titles": _TITLES,
    "creators": _CREATOR_ROWS + " SELECT * FROM creator_rows",
    "contributors": _DOCS + """
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS contributor_order,
       CAST(1 AS BIGINT) AS affiliation_order, 'DataCollector' AS contributor_type,
       customer AS contributor_name, CAST(NULL AS VARCHAR) AS contributor_name_type,
       CAST(NULL AS VARCHAR) AS given_name, CAST(NULL AS VARCHAR) AS family_name,
       CASE WHEN k % 8 = 0 THEN 'C1' END AS name_identifier,
       CAST(NULL AS VARCHAR) AS name_identifier_scheme,
       CAST(NULL AS VARCHAR) AS name_identifier_scheme_uri, CAST(NULL AS VARCHAR) AS scheme_uri,
       CASE WHEN k % 8 = 0 THEN 'Office of ' || nation END AS affiliation_name,
       CAST(NULL AS VARCHAR) AS affiliation_identifier,
       CAST(NULL AS VARCHAR) AS affiliation_identifier_scheme
FROM ok WHERE k % 4 = 0""",
    "subjects": _DOCS + """
SELECT record_id, source_xml_path, i AS subject_order, segment || ' topic ' || i AS subject_text,
       'segment' AS subject_scheme, CAST(NULL AS VARCHAR) AS scheme_uri,
       CAST(NULL AS VARCHAR) AS value_uri,
       CASE WHEN i % 2 = 0 THEN CAST(i AS VARCHAR) END AS classification_code,
       CASE WHEN i = 3 THEN 'de' END AS xml_lang
FROM ok, unnest(range(1, k % 5 + 1)) AS t(i)""",
    "dates": _DOCS + """, listed AS (
  SELECT ok.*, CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS blanks FROM ok
)
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS date_order, 'Issued' AS date_type,
       CAST(NULL AS VARCHAR) AS date_value_raw, CAST(NULL AS DATE) AS date_value,
       CAST(NULL AS VARCHAR) AS date_information
FROM listed WHERE blanks = 1
UNION ALL
SELECT record_id, source_xml_path, 1 + blanks, 'Issued',
       CASE WHEN k % 5 = 0 THEN strftime(order_date, '%Y-%m') ELSE strftime(order_date, '%Y-%m-%d') END,
       CASE WHEN k % 5 <> 0 THEN order_date END, NULL
FROM listed
UNION ALL
SELECT record_id, source_xml_path, 2 + blanks, 'Updated',
       strftime(order_date + CAST(k % 30 AS INTEGER), '%Y-%m-%d'),
       order_date + CAST(k % 30 AS INTEGER), 'x'
FROM listed WHERE k % 3 <> 0""",
    "related_identifiers": _DOCS + """
SELECT record_id, source_xml_path, i AS related_identifier_order,
       '10.2/' || (k + i) AS related_identifier, 'DOI' AS related_identifier_type,
       CASE WHEN i = 1 THEN 'References' ELSE 'IsPartOf' END AS relation_type,
       CAST(NULL AS VARCHAR) AS related_metadata_scheme, CAST(NULL AS VARCHAR) AS scheme_uri,
       CAST(NULL AS VARCHAR) AS scheme_type, CAST(NULL AS VARCHAR) AS resource_type_general
FROM ok, unnest(range(1, (k + 1) % 3 + 1)) AS t(i)""",
    "rights": _DOCS + """
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS rights_order, 'Some licence' AS rights_text,
       CAST(NULL AS VARCHAR) AS rights_uri, 'lic' AS rights_identifier,
       CAST(NULL AS VARCHAR) AS rights_identifier_scheme, CAST(NULL AS VARCHAR) AS scheme_uri,
       'en' AS xml_lang
FROM ok
UNION ALL
SELECT record_id, source_xml_path, 2, NULL,
       'info:eu-repo/semantics/' || CASE WHEN status = 'F' THEN 'openAccess' ELSE 'restrictedAccess' END,
       NULL, NULL, NULL, NULL
FROM ok""",
    "descriptions": _DOCS + """
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS description_order,
       'Abstract' AS description_type, '<p>' || segment || '</p>' AS description_text,
       CAST(NULL AS VARCHAR) AS xml_lang
FROM ok""",
    "alternate_identifiers": _DOCS + """
SELECT record_id, source_xml_path, CAST(1 AS BIGINT) AS alternate_identifier_order,
       'https://x.example/records/' || k || CASE WHEN k % 3 = 1 THEN '/files' ELSE '' END
         AS alternate_identifier,
       'URL' AS alternate_identifier_type
FROM ok WHERE k % 3 < 2
UNION ALL
SELECT record_id, source_xml_path, 2,
       'oai:x.example:' || CASE WHEN k % 3 = 0 THEN k + 1000000 ELSE k END, 'oai'
FROM ok WHERE k % 3 < 2""",
    "issues": _ISSUES + " SELECT * FROM found",
    "issues_strict": _FIRST_WARNING + """
SELECT 'WARNING' AS severity, code, message, '/xml/' || file_name AS source_xml_path,
       file_name AS source_file_name, record_id, context
FROM first_w
UNION ALL
SELECT 'ERROR', 'PARSE_EXCEPTION',
       CASE WHEN malformed THEN 'malformed'
            WHEN strict_message IS NOT NULL THEN strict_message
            ELSE 'Missing /oai_datacite/payload/resource element' END,
       '/xml/' || d.file_name, d.file_name, NULL, 'parse_record_file'
FROM d LEFT JOIN first_w ON d.k = first_w.k
WHERE malformed OR no_resource OR first_w.k IS NOT NULL""",
    "issue_counts_by_severity": _ISSUES + """
SELECT severity, count(*) AS n FROM found GROUP BY severity""",
    "issue_counts_by_code": _ISSUES + " SELECT code, count(*) AS n FROM found GROUP BY code",
    "document_issue_signatures": _ISSUES + """
SELECT code || ': ' || message AS signature, count(*) AS n FROM found
GROUP BY ALL ORDER BY n DESC, signature LIMIT 50""",
    "run_summary": summary_sql(),
    "sql_example": _RECORDS + """
SELECT record_id, identifier, primary_title, publication_year, version
FROM recs WHERE version IS NOT NULL ORDER BY record_id LIMIT 20""",
    "star_join": _STAR_JOIN,
    "star_join_saved": _STAR_JOIN,
    "select_docs_containing": _DOCS + """
SELECT file_name FROM d WHERE k % 2 = 0 AND k % 101 <> 0 AND k % 43 <> 10""",
    "missing_files": _LISTED + " SELECT path, file_name, found FROM listed",
    "missing_file_issues": _LISTED + """
SELECT 'ERROR' AS severity, 'MISSING_INPUT_FILE' AS code,
       'No such file or directory: ' || path AS message, path AS source_xml_path,
       file_name AS source_file_name, CAST(NULL AS VARCHAR) AS record_id,
       'parse_record_file' AS context
FROM listed WHERE NOT found""",
    "write_read_parquet": _TITLES,
    "write_read_jsonl": _TITLES,
}
