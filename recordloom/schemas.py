"""Output contract: the ten flat tables, the issues table, and what counts as known.

Everything in this module is a fixed value. The column names, their order and
types, the element names and the attribute names must stay exactly as they are,
because users' queries and the meaning of every warning depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: XML namespaces of the envelope and of the metadata kernel ---
ENVELOPE_NS = "http://schema.datacite.org/oai/oai-1.1/"
KERNEL_NS = "http://datacite.org/schema/kernel-4"
XML_NS = "http://www.w3.org/XML/1998/namespace"
LANG_ATTR = "{http://www.w3.org/XML/1998/namespace}lang"

# --- fixed values: columns of each table, in contract order ---
TABLE_DDL: dict[str, str] = {
    "records": """
        record_id string, source_xml_path string, source_file_name string,
        schema_version string, datacentre_symbol string,
        identifier string, identifier_type string,
        oai_identifier string, record_url string,
        publisher string, publication_year bigint, version string,
        resource_type string, resource_type_general string,
        issued_date_raw string, issued_date date,
        updated_date_raw string, updated_date date,
        primary_title string,
        title_count bigint, description_count bigint, creator_count bigint,
        contributor_count bigint, subject_count bigint,
        related_identifier_count bigint, rights_count bigint,
        alternate_identifier_count bigint,
        access_rights_uri string, access_rights_label string,
        parse_ok boolean, parse_error string""",
    "titles": """
        record_id string, source_xml_path string, title_order bigint,
        title_text string, title_type string, xml_lang string""",
    "creators": """
        record_id string, source_xml_path string,
        creator_order bigint, affiliation_order bigint,
        creator_name string, creator_name_type string,
        given_name string, family_name string,
        name_identifier string, name_identifier_scheme string,
        name_identifier_scheme_uri string, scheme_uri string,
        affiliation_name string, affiliation_identifier string,
        affiliation_identifier_scheme string""",
    "contributors": """
        record_id string, source_xml_path string,
        contributor_order bigint, affiliation_order bigint,
        contributor_type string, contributor_name string, contributor_name_type string,
        given_name string, family_name string,
        name_identifier string, name_identifier_scheme string,
        name_identifier_scheme_uri string, scheme_uri string,
        affiliation_name string, affiliation_identifier string,
        affiliation_identifier_scheme string""",
    "subjects": """
        record_id string, source_xml_path string, subject_order bigint,
        subject_text string, subject_scheme string, scheme_uri string,
        value_uri string, classification_code string, xml_lang string""",
    "dates": """
        record_id string, source_xml_path string, date_order bigint,
        date_type string, date_value_raw string, date_value date,
        date_information string""",
    "related_identifiers": """
        record_id string, source_xml_path string, related_identifier_order bigint,
        related_identifier string, related_identifier_type string,
        relation_type string, related_metadata_scheme string,
        scheme_uri string, scheme_type string, resource_type_general string""",
    "rights": """
        record_id string, source_xml_path string, rights_order bigint,
        rights_text string, rights_uri string, rights_identifier string,
        rights_identifier_scheme string, scheme_uri string, xml_lang string""",
    "descriptions": """
        record_id string, source_xml_path string, description_order bigint,
        description_type string, description_text string, xml_lang string""",
    "alternate_identifiers": """
        record_id string, source_xml_path string, alternate_identifier_order bigint,
        alternate_identifier string, alternate_identifier_type string""",
    "issues": """
        severity string, code string, message string,
        source_xml_path string, source_file_name string,
        record_id string, context string, timestamp_utc string""",
}

# --- fixed values: children that are read, so their presence is no surprise ---
KNOWN_ROOT_CHILDREN = ["schemaVersion", "datacentreSymbol", "payload"]
KNOWN_RESOURCE_CHILDREN = [
    "identifier",
    "alternateIdentifiers",
    "creators",
    "titles",
    "publisher",
    "publicationYear",
    "version",
    "contributors",
    "subjects",
    "dates",
    "resourceType",
    "relatedIdentifiers",
    "rightsList",
    "descriptions",
]
KNOWN_CREATOR_CHILDREN = ["creatorName", "givenName", "familyName", "nameIdentifier", "affiliation"]
KNOWN_CONTRIBUTOR_CHILDREN = [
    "contributorName", "givenName", "familyName", "nameIdentifier", "affiliation",
]

# --- fixed values: attributes that are read, per element ---
KNOWN_ATTRIBUTES: dict[str, list[str]] = {
    "identifier": ["identifierType"],
    "alternateIdentifier": ["alternateIdentifierType"],
    "title": ["titleType", LANG_ATTR],
    "creatorName": ["nameType", LANG_ATTR],
    "contributorName": ["nameType", LANG_ATTR],
    "contributor": ["contributorType"],
    "nameIdentifier": ["nameIdentifierScheme", "nameIdentifierSchemeURI", "schemeURI"],
    "affiliation": ["affiliationIdentifier", "affiliationIdentifierScheme"],
    "subject": ["subjectScheme", "schemeURI", "valueURI", "classificationCode", LANG_ATTR],
    "date": ["dateType", "dateInformation"],
    "resourceType": ["resourceTypeGeneral"],
    "relatedIdentifier": [
        "relatedIdentifierType", "relationType", "relatedMetadataScheme",
        "schemeURI", "schemeType", "resourceTypeGeneral",
    ],
    "rights": [
        "rightsURI", "rightsIdentifier", "rightsIdentifierScheme", "schemeURI", LANG_ATTR,
    ],
    "description": ["descriptionType", LANG_ATTR],
}

# --- fixed value: rights URIs that state the access level ---
ACCESS_RIGHTS_PREFIX = "info:eu-repo/semantics/"

RECORD_TABLES: list[str] = [t for t in TABLE_DDL if t != "issues"]
CHILD_TABLES: list[str] = [t for t in RECORD_TABLES if t != "records"]
ALL_TABLES: list[str] = list(TABLE_DDL)


def table_schema(name: str) -> T.StructType:
    """Declared Spark schema of one output table; every field is nullable."""
    return T.StructType.fromDDL(TABLE_DDL[name])


def table_columns(name: str) -> list[str]:
    return table_schema(name).fieldNames()
