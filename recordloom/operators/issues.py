"""Data-quality issues, derived from the shredded row without Python.

All warnings of a document form one array in reading order, so strict mode needs
only its first entry: no window, no join, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.identifiers import file_name_record_id
from recordloom.functions.text import attribute_display_name_sql
from recordloom.schemas import table_columns

_WARNINGS_DDL = (
    "array<struct<code: string, message: string, strict_message: string, "
    "record_id: string, context: string>>"
)

# Error codes, messages and contexts of failed documents.
MISSING_INPUT_FILE = "MISSING_INPUT_FILE"
PARSE_EXCEPTION = "PARSE_EXCEPTION"
MISSING_RESOURCE_MESSAGE = "Missing /oai_datacite/payload/resource element"
ERROR_CONTEXT = "parse_record_file"

_OWN_ID = "own_id"
_NO_ID = "string(null)"
_EMPTY = f"cast(array() AS {_WARNINGS_DDL})"


def _no_id() -> Column:
    return F.lit(None).cast("string")


# The texts of all warnings below, with their codes and contexts, which
# readers of the issues table know.

# The warnings are one SQL expression, put together from the pieces below. Each piece
# is SQL text for an array of warnings, or null if there are none. ``record_id`` and
# ``context`` are SQL too.


def _warning(
    code: str, message: str, record_id: str, context: str, strict_message: str | None = None
) -> str:
    return (
        f"named_struct('code', '{code}', 'message', {message}, "
        f"'strict_message', {strict_message or message}, "
        f"'record_id', {record_id}, 'context', {context})"
    )


def _unknown_children(names: str, code: str, parent: str, record_id: str, context: str) -> str:
    """One warning per unknown child."""
    message = f"concat('Unhandled {parent} child element \\'', n, '\\'')"
    return f"transform({names}, n -> {_warning(code, message, record_id, context)})"


def _unknown_attributes(holder: str, element: str, record_id: str, context: str) -> str:
    """One warning per attribute that the element is not known to have."""
    message = (
        f"concat('Unhandled attribute \\'', {attribute_display_name_sql('n')}, "
        f"'\\' on element \\'{element}\\'')"
    )
    warning = _warning("UNHANDLED_ATTRIBUTE", message, record_id, context)
    return f"transform({holder}.unknown_attributes, n -> {warning})"


def _joined(*parts: str) -> str:
    return f"concat({', '.join(f'coalesce({p}, {_EMPTY})' for p in parts)})"


def _indexed(base: str, position: str) -> str:
    return f"concat({base}, '[', {position} + 1, ']')"


def _per_item(array: str, item: str, warnings_of: str, is_odd: str | None = None) -> str:
    """Warnings of every item, in order. Arrays without an odd item are not looked into.

    Inside ``warnings_of`` an item is called ``item`` and its position ``item`` + ``_i``.
    """
    odd = is_odd or f"{item}.unknown_attributes IS NOT NULL"
    every = f"transform({array}, ({item}, {item}_i) -> coalesce({warnings_of}, {_EMPTY}))"
    return f"if(exists({array}, {item} -> {odd}), flatten({every}), null)"


def _element_attributes(column: str, element: str, base: str, record_id: str) -> str:
    context = _indexed(f"'{base}'", "e_i")
    return _per_item(column, "e", _unknown_attributes("e", element, record_id, context))


# Whether a creator or contributor p can have any warning at all.
_ODD_PERSON = (
    "p.unknown_children IS NOT NULL OR size(p.name_identifiers) > 1 "
    "OR p.name.unknown_attributes IS NOT NULL "
    "OR exists(p.name_identifiers, x -> x.unknown_attributes IS NOT NULL) "
    "OR exists(p.affiliations, x -> x.unknown_attributes IS NOT NULL)"
)


def _person_warnings(column: str, element: str, own_attributes: bool) -> str:
    """Warnings of all creators or contributors, in reading order."""
    base = _indexed(f"'/resource/{column}/{element}'", "p_i")
    several = _warning(
        "MULTIPLE_NAME_IDENTIFIERS",
        f"concat('{element.capitalize()} has ', size(p.name_identifiers), "
        f"' nameIdentifier elements; only the first is mapped into {element}s table')",
        _OWN_ID,
        base,
        f"'Multiple {element} nameIdentifier elements'",
    )
    steps = [
        _unknown_children(
            "p.unknown_children", f"UNHANDLED_{element.upper()}_CHILD", element, _OWN_ID, base
        ),
        _unknown_attributes("p.name", f"{element}Name", _OWN_ID, f"concat({base}, '/{element}Name')"),
        f"if(size(p.name_identifiers) > 1, array({several}), null)",
        _unknown_attributes(
            "try_element_at(p.name_identifiers, 1)",
            "nameIdentifier",
            _OWN_ID,
            f"concat({base}, '/nameIdentifier[1]')",
        ),
        _per_item(
            "p.affiliations",
            "a",
            _unknown_attributes(
                "a", "affiliation", _OWN_ID, _indexed(f"concat({base}, '/affiliation')", "a_i")
            ),
        ),
    ]
    odd = _ODD_PERSON
    if own_attributes:
        steps.insert(0, _unknown_attributes("p", element, _OWN_ID, base))
        odd += " OR p.unknown_attributes IS NOT NULL"
    return _per_item(column, "p", _joined(*steps), odd)


def warnings() -> Column:
    """All warnings of a shredded row with an ``own_id``, in the order of reading."""
    return F.expr(
        _joined(
            _unknown_children(
                "unknown_root_children",
                "UNHANDLED_ROOT_CHILD",
                "root",
                _NO_ID,
                "'/oai_datacite'",
            ),
            _unknown_children(
                "unknown_resource_children",
                "UNHANDLED_RESOURCE_CHILD",
                "resource",
                _NO_ID,
                "'/oai_datacite/payload/resource'",
            ),
            _unknown_attributes("identifier", "identifier", _NO_ID, "'/resource/identifier'"),
            _element_attributes(
                "alternate_identifiers",
                "alternateIdentifier",
                "/resource/alternateIdentifiers/alternateIdentifier",
                _NO_ID,
            ),
            _element_attributes("titles", "title", "/resource/titles/title", _OWN_ID),
            _person_warnings("creators", "creator", own_attributes=False),
            _person_warnings("contributors", "contributor", own_attributes=True),
            _element_attributes("subjects", "subject", "/resource/subjects/subject", _OWN_ID),
            _element_attributes("dates", "date", "/resource/dates/date", _OWN_ID),
            _unknown_attributes(
                "resource_type", "resourceType", _OWN_ID, "'/resource/resourceType'"
            ),
            _element_attributes(
                "related_identifiers",
                "relatedIdentifier",
                "/resource/relatedIdentifiers/relatedIdentifier",
                _OWN_ID,
            ),
            _element_attributes("rights", "rights", "/resource/rightsList/rights", _OWN_ID),
            _element_attributes(
                "descriptions", "description", "/resource/descriptions/description", _OWN_ID
            ),
        )
    )


def issues_table(judged: DataFrame) -> DataFrame:
    """The issues of judged documents: their warnings, then the error if one failed."""
    error = F.when(
        F.col("error_code").isNotNull(),
        F.array(
            F.struct(
                F.lit("ERROR").alias("severity"),
                F.col("error_code").alias("code"),
                F.col("error_message").alias("message"),
                _no_id().alias("record_id"),
                F.lit(ERROR_CONTEXT).alias("context"),
            )
        ),
    ).otherwise(
        F.array().cast(
            "array<struct<severity: string, code: string, message: string, "
            "record_id: string, context: string>>"
        )
    )
    found = F.transform(
        F.col("warnings"),
        lambda w: F.struct(
            F.lit("WARNING").alias("severity"),
            w["code"].alias("code"),
            w["message"].alias("message"),
            w["record_id"].alias("record_id"),
            w["context"].alias("context"),
        ),
    )
    # For ``explode`` Spark infers a filter on the array and pushes it below the warnings, which are then made twice or more.
    issue = F.explode_outer(F.concat(found, error)).alias("issue")
    exploded = judged.select("path", "file_name", issue).where(F.col("issue").isNotNull())
    return exploded.select(
        "issue.severity",
        "issue.code",
        "issue.message",
        F.col("path").alias("source_xml_path"),
        F.col("file_name").alias("source_file_name"),
        "issue.record_id",
        "issue.context",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp_utc"),
    ).select(table_columns("issues"))


def judge(
    shredded: DataFrame, record_id: Column, strict: bool = False, report: bool = True
) -> DataFrame:
    """Add ``warnings``, ``error_code``, ``error_message`` and ``record_id``.

    In strict mode a document's first warning also fails the document and its later
    warnings are not reported. Warnings found before a failure stay. Without
    ``report`` there is no ``warnings`` column, and none are looked for.
    """
    # A column of its own: the warnings mention the id in many places.
    found = shredded.withColumn(_OWN_ID, record_id)
    own_id = F.col(_OWN_ID)
    message = (
        F.when(
            F.col("is_missing"), F.concat(F.lit("No such file or directory: "), F.col("path"))
        )
        .when(F.col("parser_error").isNotNull(), F.col("parser_error"))
    )
    if strict:
        first = F.slice(warnings(), 1, 1)
        found = found.withColumn("warnings", first)
        strict_message = F.try_element_at("warnings", F.lit(1))["strict_message"]
        message = message.when(strict_message.isNotNull(), strict_message)
    elif report:
        found = found.withColumn("warnings", warnings())
    message = message.when(~F.col("has_resource"), F.lit(MISSING_RESOURCE_MESSAGE))
    error_code = F.when(F.col("is_missing"), F.lit(MISSING_INPUT_FILE)).when(
        F.col("error_message").isNotNull(), F.lit(PARSE_EXCEPTION)
    )
    settled_id = F.when(F.col("error_message").isNull(), own_id).otherwise(
        file_name_record_id(F.col("file_name"))
    )
    judged = found.withColumn("error_message", message).withColumns(
        {"error_code": error_code, "record_id": settled_id}
    )
    return judged.drop(_OWN_ID)
