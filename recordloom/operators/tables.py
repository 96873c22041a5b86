"""The ten flat tables as projections of judged documents.

``judge_documents`` settles each document once (id, warnings, error). Every table is
then a ``select`` with at most two explodes: no shuffle anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.dates import parse_date_strict
from recordloom.functions.elements import (
    first_by_prefix,
    first_with_text,
    positional_first,
    text_of,
)
from recordloom.functions.identifiers import extract_record_id
from recordloom.functions.text import last_segment, normalize_text, safe_int
from recordloom.operators.issues import issues_table, judge
from recordloom.operators.shred import count_section, shred_documents
from recordloom.schemas import (
    ACCESS_RIGHTS_PREFIX,
    ALL_TABLES,
    CHILD_TABLES,
    table_columns,
    table_schema,
)

_SINGLE_SECTIONS = [
    "schema_version",
    "datacentre_symbol",
    "identifier",
    "publisher",
    "publication_year",
    "version",
    "resource_type",
]

# Counts of a record and the sections they count. Creators and contributors count
# persons, not person-affiliation rows.
_COUNTED_SECTIONS = {
    "title_count": "titles",
    "description_count": "descriptions",
    "creator_count": "creators",
    "contributor_count": "contributors",
    "subject_count": "subjects",
    "related_identifier_count": "related_identifiers",
    "rights_count": "rights",
    "alternate_identifier_count": "alternate_identifiers",
}

# Sections each table is made of; ids always need the alternate identifiers. Issues
# need all that can be odd, but no counts and no plain texts.
TABLE_SECTIONS: dict[str, list[str]] = {
    "records": [
        *_SINGLE_SECTIONS,
        *("alternate_identifiers", "titles", "dates", "rights"),
        *(count_section(s) for s in _COUNTED_SECTIONS.values()),
    ],
    **{t: ["alternate_identifiers", t] for t in CHILD_TABLES},
    "issues": [
        *("unknown_root_children", "unknown_resource_children", "identifier", "resource_type"),
        *_COUNTED_SECTIONS.values(),
        "dates",
    ],
}


def _record_url() -> Column:
    return first_with_text(F.col("alternate_identifiers"), "alternateIdentifierType", "URL")


def _oai_identifier() -> Column:
    return first_with_text(F.col("alternate_identifiers"), "alternateIdentifierType", "oai")


def judge_documents(
    docs: DataFrame, strict: bool = False, tables: Sequence[str] = ALL_TABLES
) -> DataFrame:
    """Shred documents and settle, per document, its id, its warnings and its error.

    ``tables`` names what will be derived, so that only their sections are built.
    Strict mode looks for all issues, since any warning can fail a document.
    """
    report = strict or "issues" in tables
    wanted = [s for t in (*tables, *(["issues"] if report else [])) for s in TABLE_SECTIONS[t]]
    record_id = extract_record_id(
        text_of(_record_url()), text_of(_oai_identifier()), F.col("file_name")
    )
    return judge(shred_documents(docs, wanted), record_id, strict, report)


def _order(position: Column) -> Column:
    return (F.coalesce(position, F.lit(0)) + 1).cast("bigint")


def _typed(rows: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns, in order, with the declared types."""
    return rows.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(table))
    )


def records(judged: DataFrame) -> DataFrame:
    """One row per document; a failed one keeps only its path, name, id and error."""
    ok = F.col("error_code").isNull()
    # First of all, everything large shrinks to what a record needs of it, and failed
    # documents lose it. Later expressions are then unconditional, so Spark evaluates
    # what they share once.
    needed = {
        **{s: F.col(s) for s in _SINGLE_SECTIONS},
        "alternate_identifiers": F.col("alternate_identifiers"),
        "dates": F.col("dates"),
        "first_title": positional_first(F.col("titles")),
        "access_rights_uri": first_by_prefix(
            F.col("rights.rightsURI"), ACCESS_RIGHTS_PREFIX
        ),
    }
    kept = judged.select(
        "path",
        "file_name",
        "record_id",
        "error_message",
        ok.alias("parse_ok"),
        *(F.when(ok, v).alias(n) for n, v in needed.items()),
        *(
            F.when(ok, F.col(count_section(s))).otherwise(F.lit(0)).alias(n)
            for n, s in _COUNTED_SECTIONS.items()
        ),
    )
    picked = kept.withColumns(
        {
            "record_url": text_of(_record_url()),
            "oai_identifier": text_of(_oai_identifier()),
            "issued_date_raw": text_of(first_with_text(F.col("dates"), "dateType", "Issued")),
            "updated_date_raw": text_of(first_with_text(F.col("dates"), "dateType", "Updated")),
        }
    )
    values = {
        "source_xml_path": F.col("path"),
        "source_file_name": F.col("file_name"),
        "schema_version": normalize_text(F.col("schema_version")),
        "datacentre_symbol": normalize_text(F.col("datacentre_symbol")),
        "identifier": text_of(F.col("identifier")),
        "identifier_type": F.col("identifier.identifierType"),
        "publisher": normalize_text(F.col("publisher")),
        "publication_year": safe_int(F.col("publication_year")),
        "version": normalize_text(F.col("version")),
        "resource_type": text_of(F.col("resource_type")),
        "resource_type_general": F.col("resource_type.resourceTypeGeneral"),
        "issued_date": parse_date_strict(F.col("issued_date_raw")),
        "updated_date": parse_date_strict(F.col("updated_date_raw")),
        "primary_title": text_of(F.col("first_title")),
        "access_rights_label": last_segment(F.col("access_rights_uri")),
        "parse_error": F.col("error_message"),
    }
    ready = [c for c in table_columns("records") if c not in values]
    return _typed(picked.select(*ready, *(v.alias(n) for n, v in values.items())), "records")


def _elements(judged: DataFrame, section: str, order_name: str) -> DataFrame:
    """One row per element of a section, for documents that did not fail."""
    return (
        judged.where(F.col("error_code").isNull())
        .select(
            "record_id",
            F.col("path").alias("source_xml_path"),
            F.posexplode(section).alias("pos", "el"),
        )
        .withColumn(order_name, _order(F.col("pos")))
    )


def _element_table(
    table: str,
    order_name: str,
    text_name: str,
    attributes: dict[str, str],
    dates: dict[str, str] | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """A table with one row per element: its text, its attributes, dates read from text."""

    def build(judged: DataFrame) -> DataFrame:
        el = F.col("el")
        rows = _elements(judged, table, order_name).withColumn(text_name, text_of(el))
        rows = rows.withColumns({c: el[a] for c, a in attributes.items()})
        rows = rows.withColumns({c: parse_date_strict(F.col(src)) for c, src in (dates or {}).items()})
        return _typed(rows, table)

    return build


def _person_table(
    table: str, noun: str, own_attributes: dict[str, str]
) -> Callable[[DataFrame], DataFrame]:
    """A table with one row per person and affiliation; one row if there is no affiliation."""

    def build(judged: DataFrame) -> DataFrame:
        el = F.col("el")
        people = _elements(judged, table, f"{noun}_order").withColumns(
            {
                f"{noun}_name": text_of(el["name"]),
                f"{noun}_name_type": el["name"]["nameType"],
                "given_name": normalize_text(el["given"]),
                "family_name": normalize_text(el["family"]),
                "first_id": positional_first(el["name_identifiers"]),
                **{c: el[a] for c, a in own_attributes.items()},
            }
        )
        first_id, affiliation = F.col("first_id"), F.col("affiliation")
        rows = people.select(
            "*", F.posexplode_outer(el["affiliations"]).alias("affiliation_pos", "affiliation")
        ).withColumns(
            {
                "affiliation_order": _order(F.col("affiliation_pos")),
                "name_identifier": text_of(first_id),
                "name_identifier_scheme": first_id["nameIdentifierScheme"],
                "name_identifier_scheme_uri": first_id["nameIdentifierSchemeURI"],
                "scheme_uri": first_id["schemeURI"],
                "affiliation_name": text_of(affiliation),
                "affiliation_identifier": affiliation["affiliationIdentifier"],
                "affiliation_identifier_scheme": affiliation["affiliationIdentifierScheme"],
            }
        )
        return _typed(rows, table)

    return build


titles = _element_table(
    "titles", "title_order", "title_text", {"title_type": "titleType", "xml_lang": "xml_lang"}
)
creators = _person_table("creators", "creator", {})
contributors = _person_table(
    "contributors", "contributor", {"contributor_type": "contributorType"}
)
subjects = _element_table(
    "subjects",
    "subject_order",
    "subject_text",
    {
        "subject_scheme": "subjectScheme",
        "scheme_uri": "schemeURI",
        "value_uri": "valueURI",
        "classification_code": "classificationCode",
        "xml_lang": "xml_lang",
    },
)
dates = _element_table(
    "dates",
    "date_order",
    "date_value_raw",
    {"date_type": "dateType", "date_information": "dateInformation"},
    {"date_value": "date_value_raw"},
)
related_identifiers = _element_table(
    "related_identifiers",
    "related_identifier_order",
    "related_identifier",
    {
        "related_identifier_type": "relatedIdentifierType",
        "relation_type": "relationType",
        "related_metadata_scheme": "relatedMetadataScheme",
        "scheme_uri": "schemeURI",
        "scheme_type": "schemeType",
        "resource_type_general": "resourceTypeGeneral",
    },
)
rights = _element_table(
    "rights",
    "rights_order",
    "rights_text",
    {
        "rights_uri": "rightsURI",
        "rights_identifier": "rightsIdentifier",
        "rights_identifier_scheme": "rightsIdentifierScheme",
        "scheme_uri": "schemeURI",
        "xml_lang": "xml_lang",
    },
)
descriptions = _element_table(
    "descriptions",
    "description_order",
    "description_text",
    {"description_type": "descriptionType", "xml_lang": "xml_lang"},
)
alternate_identifiers = _element_table(
    "alternate_identifiers",
    "alternate_identifier_order",
    "alternate_identifier",
    {"alternate_identifier_type": "alternateIdentifierType"},
)

TABLE_BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "records": records,
    "titles": titles,
    "creators": creators,
    "contributors": contributors,
    "subjects": subjects,
    "dates": dates,
    "related_identifiers": related_identifiers,
    "rights": rights,
    "descriptions": descriptions,
    "alternate_identifiers": alternate_identifiers,
    "issues": issues_table,
}


def derive_tables(judged: DataFrame, tables: Sequence[str] = ALL_TABLES) -> dict[str, DataFrame]:
    """The named tables of judged documents. Give it stored rows if it is to derive several."""
    return {name: TABLE_BUILDERS[name](judged) for name in tables}


def table_from_documents(docs: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """One table straight from documents."""
    return TABLE_BUILDERS[table](judge_documents(docs, strict, [table]))
