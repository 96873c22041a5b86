"""The golden documents, through files, in tolerant and strict mode."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from recordloom.operators import table_from_documents
from recordloom.operators.tables import TABLE_BUILDERS
from recordloom.plans import extract_tables
from recordloom.schemas import ALL_TABLES, CHILD_TABLES, RECORD_TABLES, table_schema
from recordloom.sources import read_xml_dir, read_xml_list, select_docs_containing
from tests import golden


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("golden")
    golden.write_all(path)
    return path


@pytest.fixture(scope="module")
def rows(spark, folder):
    """Table name -> file name -> rows, in order."""
    _, tables = extract_tables(read_xml_dir(spark, str(folder)))
    return {name: by_file(df) for name, df in tables.items()}


def by_file(df):
    found = {}
    for row in df.collect():
        found.setdefault(row.source_xml_path.rsplit("/", 1)[-1], []).append(row)
    orders = [c for c in df.columns if c.endswith("_order")]
    for listed in found.values():
        listed.sort(key=lambda r: [r[c] for c in orders])
    return found


def record(rows, name):
    (only,) = rows["records"][name]
    return only


def test_schemas_are_exact(spark, folder):
    docs = read_xml_dir(spark, str(folder))
    for name in ALL_TABLES:
        got = table_from_documents(docs, name).schema
        want = table_schema(name)
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want], name


def test_single_table_equals_the_one_of_a_full_run(spark, folder, rows):
    docs = read_xml_dir(spark, str(folder))
    for name in RECORD_TABLES:
        assert by_file(table_from_documents(docs, name)) == rows[name], name


def test_one_record_per_file_and_plain_paths(rows, folder):
    assert set(rows["records"]) == set(golden.DOCS)
    assert record(rows, "7.xml").source_xml_path == f"{folder}/a/b/7.xml"
    assert record(rows, "7.xml").source_file_name == "7.xml"


def test_text(rows):
    (title,) = rows["titles"]["7.xml"]
    assert (title.title_text, title.xml_lang) == ("Hello wor ld tail", "en")
    assert [t.title_text for t in rows["titles"]["8.xml"]] == [None, "x"]
    assert record(rows, "8.xml").primary_title is None
    assert record(rows, "8.xml").title_count == 2
    assert rows["titles"]["9.xml"][0].title_text == "a <b>c</b> & de"
    assert "21.xml" not in rows["titles"] and "21.xml" not in rows["issues"]
    assert record(rows, "26.xml").publisher == "Café"
    assert [t.title_text for t in rows["titles"]["25.xml"]] == ["one", "two"]


def test_creators(rows):
    got = [
        (r.creator_order, r.affiliation_order, r.affiliation_name) for r in rows["creators"]["10.xml"]
    ]
    assert got == [(1, 1, "X"), (1, 2, "Y"), (2, 1, None)]
    assert record(rows, "10.xml").creator_count == 2
    (only,) = rows["creators"]["11.xml"]
    assert only.name_identifier == "1"
    (issue,) = rows["issues"]["11.xml"]
    assert issue.code == "MULTIPLE_NAME_IDENTIFIERS"
    assert issue.message == (
        "Creator has 2 nameIdentifier elements; only the first is mapped into creators table"
    )
    assert (issue.record_id, issue.context) == ("11", "/resource/creators/creator[1]")


def test_dates(rows):
    r = record(rows, "12.xml")
    assert (r.issued_date_raw, r.issued_date, r.updated_date_raw, r.updated_date) == (
        "2020-01", None, "20200103", None,
    )
    r = record(rows, "13.xml")
    assert (r.issued_date_raw, r.issued_date) == ("2020-01-02", dt.date(2020, 1, 2))
    assert record(rows, "20.xml").publication_year is None
    assert rows["dates"]["25.xml"][0].date_value is None


def test_record_ids(rows):
    ids = {n: record(rows, n).record_id for n in ("14.xml", "15.xml", "16-a.xml", "abc.xml")}
    assert ids == {"14.xml": "99", "15.xml": "98", "16-a.xml": "16", "abc.xml": None}
    assert record(rows, "15.xml").record_url == "https://x.example/records/99/files"
    assert {r.record_id for r in rows["alternate_identifiers"]["14.xml"]} == {"99"}


def test_rights(rows):
    r = record(rows, "17.xml")
    assert r.access_rights_label == "openAccess"
    assert r.access_rights_uri == "info:eu-repo/semantics/openAccess"
    assert r.rights_count == 2


def test_unknown_parts(rows):
    got = [(i.message, i.record_id, i.context) for i in rows["issues"]["18.xml"]]
    path = "/oai_datacite/payload/resource"
    assert got == [
        ("Unhandled resource child element 'language'", None, path),
        ("Unhandled resource child element 'geoLocations'", None, path),
        ("Unhandled resource child element 'geoLocations'", None, path),
    ]
    (issue,) = rows["issues"]["19.xml"]
    assert issue.message == "Unhandled attribute 'extra' on element 'description'"
    assert (issue.record_id, issue.context) == ("19", "/resource/descriptions/description[1]")


# Reading order of everything unusual in 25.xml: (code, message tail, has id, context).
EVERYTHING = [
    ("UNHANDLED_ROOT_CHILD", "'more'", False, "/oai_datacite"),
    ("UNHANDLED_RESOURCE_CHILD", "'sizes'", False, "/oai_datacite/payload/resource"),
    ("UNHANDLED_ATTRIBUTE", "'a' on element 'identifier'", False, "/resource/identifier"),
    ("UNHANDLED_ATTRIBUTE", "'b' on element 'alternateIdentifier'", False,
     "/resource/alternateIdentifiers/alternateIdentifier[1]"),
    ("UNHANDLED_ATTRIBUTE", "'xml:space' on element 'title'", True, "/resource/titles/title[1]"),
    ("UNHANDLED_CREATOR_CHILD", "'extra'", True, "/resource/creators/creator[1]"),
    ("UNHANDLED_ATTRIBUTE", "'c' on element 'creatorName'", True,
     "/resource/creators/creator[1]/creatorName"),
    ("UNHANDLED_ATTRIBUTE", "'d' on element 'nameIdentifier'", True,
     "/resource/creators/creator[1]/nameIdentifier[1]"),
    ("UNHANDLED_ATTRIBUTE", "'e' on element 'affiliation'", True,
     "/resource/creators/creator[1]/affiliation[1]"),
    ("UNHANDLED_ATTRIBUTE", "'f' on element 'contributor'", True,
     "/resource/contributors/contributor[1]"),
    ("UNHANDLED_CONTRIBUTOR_CHILD", "'odd'", True, "/resource/contributors/contributor[1]"),
    ("UNHANDLED_ATTRIBUTE", "'g' on element 'contributorName'", True,
     "/resource/contributors/contributor[1]/contributorName"),
    ("MULTIPLE_NAME_IDENTIFIERS", "contributors table", True,
     "/resource/contributors/contributor[1]"),
    ("UNHANDLED_ATTRIBUTE", "'h' on element 'affiliation'", True,
     "/resource/contributors/contributor[1]/affiliation[1]"),
    ("UNHANDLED_ATTRIBUTE", "'i' on element 'subject'", True, "/resource/subjects/subject[1]"),
    ("UNHANDLED_ATTRIBUTE", "'j' on element 'date'", True, "/resource/dates/date[1]"),
    ("UNHANDLED_ATTRIBUTE", "'k' on element 'resourceType'", True, "/resource/resourceType"),
    ("UNHANDLED_ATTRIBUTE", "'l' on element 'relatedIdentifier'", True,
     "/resource/relatedIdentifiers/relatedIdentifier[1]"),
    ("UNHANDLED_ATTRIBUTE", "'m' on element 'rights'", True, "/resource/rightsList/rights[1]"),
    ("UNHANDLED_ATTRIBUTE", "'{urn:q}n' on element 'description'", True,
     "/resource/descriptions/description[1]"),
]


def test_every_warning_in_reading_order(rows):
    found = rows["issues"]["25.xml"]
    assert [(i.code, i.record_id is not None, i.context) for i in found] == [
        (code, has_id, context) for code, _, has_id, context in EVERYTHING
    ]
    for issue, (_, tail, _, _) in zip(found, EVERYTHING):
        assert issue.message.endswith(tail)
        assert issue.severity == "WARNING"


def test_broken_documents(rows):
    for name, code in (("22.xml", "PARSE_EXCEPTION"), ("23.xml", "PARSE_EXCEPTION")):
        r = record(rows, name)
        assert (r.parse_ok, r.record_id, r.title_count, r.schema_version) == (False, name[:2], 0, None)
        assert r.parse_error
        assert not any(name in rows[t] for t in CHILD_TABLES)
        last = rows["issues"][name][-1]
        assert (last.severity, last.code, last.record_id, last.context) == (
            "ERROR", code, None, "parse_record_file",
        )
    warned, failed = rows["issues"]["23.xml"]
    assert warned.code == "UNHANDLED_ROOT_CHILD"
    assert failed.message == "Missing /oai_datacite/payload/resource element"


def test_strict_mode(spark, folder):
    docs = read_xml_dir(spark, str(folder))
    issues = by_file(table_from_documents(docs, "issues", strict=True))
    records = by_file(table_from_documents(docs, "records", strict=True))
    titles = by_file(table_from_documents(docs, "titles", strict=True))
    warned, failed = issues["18.xml"]
    assert (warned.severity, failed.code) == ("WARNING", "PARSE_EXCEPTION")
    assert failed.message == warned.message == "Unhandled resource child element 'language'"
    assert records["18.xml"][0].parse_ok is False
    assert issues["11.xml"][1].message == "Multiple creator nameIdentifier elements"
    assert [i.code for i in issues["25.xml"]] == ["UNHANDLED_ROOT_CHILD", "PARSE_EXCEPTION"]
    assert issues["23.xml"][1].message == "Unhandled root child element 'surprise'"
    assert "25.xml" not in titles and "7.xml" in titles
    assert records["7.xml"][0].parse_ok is True


def test_file_list(spark, folder):
    inside = folder / "a" / "b"
    (inside / "list.txt").write_text(f"7.xml\n\n  ./8.xml \n{inside}/9.xml\n24.xml\n7.xml\n")
    docs = read_xml_list(spark, str(inside / "list.txt"))
    got = sorted((r.file_name, r.content is None) for r in docs.collect())
    assert got == [("24.xml", True), ("7.xml", False), ("7.xml", False), ("8.xml", False), ("9.xml", False)]
    relative = read_xml_list(spark, os.path.relpath(inside / "list.txt"))
    assert relative.exceptAll(docs).count() == docs.exceptAll(relative).count() == 0
    missing = by_file(table_from_documents(docs, "records"))["24.xml"][0]
    assert (missing.parse_ok, missing.record_id) == (False, "24")
    (issue,) = by_file(table_from_documents(docs, "issues"))["24.xml"]
    assert issue.code == "MISSING_INPUT_FILE"
    assert issue.message == f"No such file or directory: {inside}/24.xml"


def test_listed_names_with_spaces_and_signs(spark, tmp_path):
    odd = tmp_path / "x + y"
    odd.mkdir()
    (odd / "7 a+b%20.xml").write_text(golden.DOCS["7.xml"])
    (odd / "list.txt").write_text("7 a+b%20.xml\n")
    (doc,) = read_xml_list(spark, str(odd / "list.txt")).collect()
    assert (doc.path, doc.content is not None) == (f"{odd}/7 a+b%20.xml", True)


def test_ordered_listing_and_literal_filter(spark, folder):
    docs = read_xml_dir(spark, str(folder))
    paths = [r.path for r in docs.select("path").collect()]
    assert paths == sorted(paths) and len(paths) == len(golden.DOCS)
    with_cdata = select_docs_containing(docs, "<![CDATA[a").select("file_name").collect()
    assert [r.file_name for r in with_cdata] == ["9.xml"]


def test_counts_equal_child_rows(rows):
    sizes = {
        "titles": "title_count", "descriptions": "description_count", "subjects": "subject_count",
        "related_identifiers": "related_identifier_count", "rights": "rights_count",
        "alternate_identifiers": "alternate_identifier_count",
    }
    for table, count in sizes.items():
        total = sum(r[count] for listed in rows["records"].values() for r in listed)
        assert total == sum(len(listed) for listed in rows[table].values()), table


def test_every_table_has_a_builder():
    assert set(TABLE_BUILDERS) == set(ALL_TABLES)


def test_many_batches_keep_every_document(spark):
    """More documents than one output batch holds, and one larger than its byte limit."""
    small = golden.DOCS["7.xml"].encode()
    huge = golden.doc(f"<descriptions><description>{'x ' * 9_000_000}</description></descriptions>")
    docs = (
        spark.range(1500, numPartitions=1)
        .select(
            F.concat(F.lit("/x/"), "id", F.lit(".xml")).alias("path"),
            F.concat("id", F.lit(".xml")).alias("file_name"),
            F.when(F.col("id") == 700, F.lit(huge.encode())).otherwise(F.lit(small)).alias("content"),
        )
    )
    assert table_from_documents(docs, "titles").select("record_id").distinct().count() == 1499
    (row,) = table_from_documents(docs, "descriptions").collect()
    assert len(row.description_text) == 2 * 9_000_000 - 1
