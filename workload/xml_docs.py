"""XML documents made from the tables: one per order, by rules plain SQL can repeat.

Each document is a function of its order row and the customer joined to it. Nothing
is grouped, so the work grows with the orders and no order or customer, however
frequent, gathers rows in one task; AQE splits a hot customer in the join.

The document is one SQL expression, put together below from literals and columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.schemas import ENVELOPE_NS, KERNEL_NS


class Sql(str):
    """SQL text, as opposed to a plain string, which means itself."""


K = Sql("string(k)")
STATUS, PRIORITY = Sql("status"), Sql("priority")
CUSTOMER, SEGMENT, NATION = Sql("customer"), Sql("segment"), Sql("nation")


def _text(*parts: str) -> Sql:
    """All parts joined to one text."""
    return Sql(f"concat({', '.join(_sql(p) for p in parts)})")


def _sql(part: str) -> str:
    if isinstance(part, Sql):
        return part
    return "'" + part.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _if(condition: str, *parts: str) -> Sql:
    return _choose(condition, _text(*parts), "")


def _choose(condition: str, yes: str, no: str) -> Sql:
    return Sql(f"if({condition}, {_sql(yes)}, {_sql(no)})")


def _repeat(count: str, name: str, item: Callable[[Sql], Sql]) -> Sql:
    """The texts of items 1..count, joined; ``name`` is the item number inside ``item``."""
    positions = f"if({count} < 1, array(), sequence(1, int({count})))"
    return Sql(f"array_join(transform({positions}, {name} -> {item(Sql(f'string({name})'))}), '')")


def _extra(n: int, item: str = "true") -> Sql:
    """An attribute that no element is known to have, in every 43rd document, for each kind of element in others."""
    return _if(f"k % 43 = {n} AND {item}", ' extra="q"')


def _creator(i: Sql) -> Sql:
    return _text(
        '<creator><creatorName nameType="',
        _choose("i % 2 = 1", "Organizational", "Personal"),
        '"', _extra(3, "i = 1"), ">", CUSTOMER, " / ", i, "</creatorName>",
        _if("i % 2 = 0", "<givenName>G", i, "</givenName><familyName> ", SEGMENT, "</familyName>"),
        _repeat(
            "(k + i) % 4", "j",
            lambda j: _text(
                '<nameIdentifier nameIdentifierScheme="ORCID" schemeURI="https://orcid.example"',
                _extra(4, "i = 1 AND j = 1"), ">",
                "ID-", K, "-", i, "-", j, "</nameIdentifier>",
            ),
        ),
        _repeat(
            "(k + i) % 3", "a",
            lambda a: _text(
                "<affiliation",
                _if("a = 1", ' affiliationIdentifier="ror:', K, '" affiliationIdentifierScheme="ROR"'),
                _extra(5, "i = 1 AND a = 1"), ">Dept ", a, " of ", NATION, "</affiliation>",
            ),
        ),
        _if("k % 19 = 0 AND i = 1", "<note>n</note>"),
        "</creator>",
    )


def _contributor() -> Sql:
    return _if(
        "k % 4 = 0",
        '<contributors><contributor contributorType="DataCollector"', _extra(6), "><contributorName", _extra(7), ">",
        CUSTOMER,
        "</contributorName>",
        _if(
            "k % 8 = 0",
            "<nameIdentifier>C1</nameIdentifier><nameIdentifier>C2</nameIdentifier>",
            "<affiliation>Office of ", NATION, "</affiliation>",
        ),
        _if("k % 23 = 0", "<role>r</role>"),
        "</contributor></contributors>",
    )


def _titles() -> Sql:
    return _text(
        "<titles><title",
        _if("k % 6 = 0", ' xml:lang="en"'),
        _if("k % 13 = 0", ' extra="q"'),
        ">  ", PRIORITY, "\n  order   ", K, " </title>",
        _if(
            "k % 2 = 0",
            '<title titleType="Subtitle">status <i>', STATUS, "</i>\n<![CDATA[<b>]]></title>",
        ),
        "</titles>",
    )


def _dates() -> Sql:
    updated = Sql("string(date_add(order_date, int(k % 30)))")
    return _text(
        "<dates>",
        _if("k % 11 = 0", '<date dateType="Issued"> </date>'),
        '<date dateType="Issued"', _extra(9), ">",
        _choose("k % 5 = 0", Sql("date_format(order_date, 'yyyy-MM')"), Sql("string(order_date)")),
        "</date>",
        _if("k % 3 <> 0", '<date dateType="Updated" dateInformation="x">', updated, "</date>"),
        "</dates>",
    )


def _subject(i: Sql) -> Sql:
    return _text(
        '<subject subjectScheme="segment"',
        _if("i % 2 = 0", ' classificationCode="', i, '"'),
        _if("i = 3", ' xml:lang="de"'),
        _extra(8, "i = 1"), ">", SEGMENT, " topic ", i, "</subject>",
    )


def _related(i: Sql) -> Sql:
    return _text(
        '<relatedIdentifier relatedIdentifierType="DOI" relationType="',
        _choose("i = 1", "References", "IsPartOf"),
        '"', _extra(11, "i = 1"), ">10.2/", Sql("string(k + i)"), "</relatedIdentifier>",
    )


def _alternate_identifiers() -> Sql:
    """The id by three routes, each with a decoy that shows when the wrong one is taken."""
    url = _text(
        '<alternateIdentifier alternateIdentifierType="URL"', _extra(2), ">https://x.example/records/"
    )
    oai = '<alternateIdentifier alternateIdentifierType="oai">oai:x.example:'
    end = "</alternateIdentifier>"
    return _text(
        "<alternateIdentifiers>",
        _if("k % 3 = 0", url, K, end, oai, Sql("string(k + 1000000)"), end),
        _if("k % 3 = 1", url, K, "/files", end, oai, K, end),
        "</alternateIdentifiers>",
    )


def _resource() -> Sql:
    return _text(
        f'<resource xmlns="{KERNEL_NS}">',
        '<identifier identifierType="DOI"', _extra(1), ">10.1/", K, "</identifier>",
        _alternate_identifiers(),
        "<creators>", _repeat("k % 4", "i", _creator), "</creators>",
        _titles(),
        "<publisher>", NATION, " Press</publisher>",
        "<publicationYear>",
        _choose("k % 7 = 0", "n.d.", Sql("string(year(order_date))")),
        "</publicationYear>",
        _if("k % 10 = 0", "<language>en</language>"),
        '<resourceType resourceTypeGeneral="', _choose("k % 2 = 0", "Dataset", "Text"),
        '"', _extra(10), ">Data of ", STATUS, "</resourceType>",
        _contributor(),
        "<subjects>", _repeat("k % 5", "i", _subject), "</subjects>",
        _dates(),
        "<relatedIdentifiers>", _repeat("(k + 1) % 3", "i", _related), "</relatedIdentifiers>",
        '<rightsList><rights xml:lang="en" rightsIdentifier="lic"', _extra(12), ">Some licence</rights>",
        '<rights rightsURI="info:eu-repo/semantics/',
        _choose("status = 'F'", "openAccess", "restrictedAccess"),
        '"/></rightsList>',
        '<descriptions><description descriptionType="Abstract"', _extra(13), ">&lt;p&gt;",
        SEGMENT,
        "&lt;/p&gt;</description></descriptions>",
        _if("k % 2 = 1", "<version>v", Sql("string(k % 10)"), "</version>"),
        _if("k % 25 = 0", "<fundingReferences><f/></fundingReferences>"),
        "</resource>",
    )


def _document() -> Sql:
    """Every 97th document lacks its closing root tag, every 101st its resource."""
    return _text(
        f'<?xml version="1.0" encoding="UTF-8"?>\n<oai_datacite xmlns="{ENVELOPE_NS}">',
        "<!-- one order -->",
        "<schemaVersion>4.3</schemaVersion><datacentreSymbol>X.Y</datacentreSymbol>",
        _if("k % 17 = 0", "<oaiNote/>"),
        "<payload>",
        _choose("k % 101 = 0", "", _resource()),
        "</payload>",
        _if("k % 97 <> 0", "</oai_datacite>"),
    )


def _escaped(column: str) -> str:
    """Column text with the characters XML reserves written as entities."""
    text = column
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = f"replace({text}, '{raw}', '{entity}')"
    return f"coalesce({text}, '')"


def build_xml(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Documents ``path, file_name, content`` for every order.

    The work is heavy per row and starts from few files, so the orders are dealt out to
    ``partitions`` tasks, by default one for each core.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(
        partitions or spark.sparkContext.defaultParallelism
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rows = (
        orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
        .join(nations, customers.c_nationkey == nations.n_nationkey, "left")
        .selectExpr(
            "o_orderkey AS k",
            "o_orderstatus AS status",
            "to_date(o_orderdate) AS order_date",
            f"{_escaped('o_orderpriority')} AS priority",
            f"{_escaped('c_name')} AS customer",
            f"{_escaped('c_mktsegment')} AS segment",
            f"{_escaped('n_name')} AS nation",
        )
    )
    name = _choose("k % 3 = 2", _text(K, ".xml"), _text("doc-", K, ".xml"))
    return rows.select(
        F.expr(_text("/xml/", name)).alias("path"),
        F.expr(name).alias("file_name"),
        F.expr(_document()).cast("binary").alias("content"),
    )
