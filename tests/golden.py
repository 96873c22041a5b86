"""Hand-written documents, each with one difficulty."""

ENVELOPE = 'xmlns="http://schema.datacite.org/oai/oai-1.1/"'
KERNEL = 'xmlns="http://datacite.org/schema/kernel-4"'


def doc(body: str, extra_root: str = "") -> str:
    return (
        f'<?xml version="1.0" encoding="UTF-8"?><oai_datacite {ENVELOPE}>'
        f"<schemaVersion>4</schemaVersion>{extra_root}"
        f"<payload><resource {KERNEL}>{body}</resource></payload></oai_datacite>"
    )


def alt(kind: str, value: str) -> str:
    return f'<alternateIdentifier alternateIdentifierType="{kind}">{value}</alternateIdentifier>'


DOCS = {
    "7.xml": doc('<titles><title xml:lang="en">Hello   <i>wor\nld</i> tail</title></titles>'),
    "8.xml": doc('<titles><title>  </title><title titleType="Sub">x</title></titles>'),
    "9.xml": doc("<titles><title><![CDATA[a <b>c</b>]]> &amp; d<!-- no -->e</title></titles>"),
    "10.xml": doc(
        "<creators><creator><creatorName>A</creatorName><affiliation>X</affiliation>"
        "<affiliation>Y</affiliation></creator><creator><creatorName>B</creatorName></creator></creators>"
    ),
    "11.xml": doc(
        "<creators><creator><creatorName>A</creatorName><nameIdentifier>1</nameIdentifier>"
        "<nameIdentifier bad='x'>2</nameIdentifier></creator></creators>"
    ),
    "12.xml": doc(
        '<dates><date dateType="Issued">2020-01</date><date dateType="Issued">2020-01-02</date>'
        '<date dateType="Updated">20200103</date></dates>'
    ),
    "13.xml": doc(
        '<dates><date dateType="Issued"/><date dateType="Issued">2020-01-02</date></dates>'
    ),
    "14.xml": doc(
        "<alternateIdentifiers>" + alt("URL", "https://x.example/records/99") + alt("oai", "oai:x:98")
        + "</alternateIdentifiers>"
    ),
    "15.xml": doc(
        "<alternateIdentifiers>" + alt("URL", "https://x.example/records/99/files")
        + alt("oai", "oai:x:98") + "</alternateIdentifiers>"
    ),
    "16-a.xml": doc(""),
    "abc.xml": doc(""),
    "17.xml": doc(
        '<rightsList><rights rightsURI="https://l.example/by">L</rights>'
        '<rights rightsURI="info:eu-repo/semantics/openAccess"/></rightsList>'
    ),
    "18.xml": doc("<language>en</language><geoLocations/><geoLocations/>"),
    "19.xml": doc('<descriptions><description descriptionType="Abstract" extra="q">t</description></descriptions>'),
    "20.xml": doc("<publicationYear>n.d.</publicationYear>"),
    "21.xml": doc('<titles><title xmlns="urn:other">no</title></titles>'),
    "22.xml": f"<oai_datacite {ENVELOPE}><payload>",
    "23.xml": f"<oai_datacite {ENVELOPE}><surprise/><payload/></oai_datacite>",
    # Two containers, a foreign xml: attribute, every section that can have a warning.
    "25.xml": doc(
        '<identifier identifierType="DOI" a="1">10.1/25</identifier>'
        '<alternateIdentifiers><alternateIdentifier b="1">z</alternateIdentifier></alternateIdentifiers>'
        '<titles><title xml:space="preserve">one</title></titles><titles><title>two</title></titles>'
        '<creators><creator ok="1"><creatorName c="1">N</creatorName><givenName>G</givenName>'
        '<familyName>F</familyName><nameIdentifier d="1" nameIdentifierSchemeURI="s">I</nameIdentifier>'
        '<affiliation e="1">O</affiliation><extra/></creator></creators>'
        '<contributors><contributor contributorType="Editor" f="1"><contributorName g="1">C</contributorName>'
        "<nameIdentifier>1</nameIdentifier><nameIdentifier>2</nameIdentifier>"
        '<affiliation h="1">O</affiliation><odd/></contributor></contributors>'
        '<subjects><subject i="1">s</subject></subjects>'
        '<dates><date j="1">2020-02-30</date></dates>'
        '<resourceType k="1">R</resourceType>'
        '<relatedIdentifiers><relatedIdentifier l="1">r</relatedIdentifier></relatedIdentifiers>'
        '<rightsList><rights m="1"/></rightsList>'
        '<descriptions><description xmlns:q="urn:q" q:n="1">d</description></descriptions>'
        "<sizes/>",
        extra_root="<more/>",
    ),
    "26.xml": '<?xml version="1.0" encoding="ISO-8859-1"?>' + doc("<publisher>Café</publisher>").split("?>", 1)[1],
}


def write_all(folder) -> None:
    nested = folder / "a" / "b"
    nested.mkdir(parents=True)
    for name, text in DOCS.items():
        encoding = "latin-1" if "ISO-8859-1" in text else "utf-8"
        (nested / name).write_bytes(text.encode(encoding))
    (nested / "notes.txt").write_text("not a document")
