"""XML documents to one nested row each: the only place where Python sees the data.

Spark's XML functions lose text around child elements and drop unknown children
and attributes silently, which are exactly the things to report. So each document
is parsed inside ``mapInArrow`` and handed back as nested columns: raw texts, the known
attributes, and the names of whatever is not known. All rules (normalisation, ids,
counts, warnings) are Column expressions downstream.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from recordloom.schemas import (
    ENVELOPE_NS,
    KERNEL_NS,
    KNOWN_ATTRIBUTES,
    KNOWN_CONTRIBUTOR_CHILDREN,
    KNOWN_CREATOR_CHILDREN,
    KNOWN_RESOURCE_CHILDREN,
    KNOWN_ROOT_CHILDREN,
    LANG_ATTR,
)

# Ship this module's functions with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PAYLOAD, _RESOURCE = f"{{{ENVELOPE_NS}}}payload", f"{{{KERNEL_NS}}}resource"

# Output batches are cut at so many documents or bytes of XML, whichever comes first.
# Small batches keep few Python objects alive; the byte limit keeps long documents
# far from Arrow's 2 GiB limit per string column.
_BATCH_DOCS = 512
_BATCH_BYTES = 16 * 1024 * 1024

# Children of one parent, grouped by qualified tag, each group in document order.
_Children = dict[str, list[ElementTree.Element]]
_Reader = Callable[..., object]
_NAMES = pa.list_(pa.string())


def _kernel(tag: str) -> str:
    return f"{{{KERNEL_NS}}}{tag}"


def _by_tag(parent) -> _Children:
    groups: _Children = {}
    for child in parent:
        groups.setdefault(child.tag, []).append(child)
    return groups


def _text(el) -> str:
    return "".join(el.itertext()) if len(el) else el.text or ""


def _first(children: _Children, tag: str, read: _Reader) -> object:
    found = children.get(tag)
    return read(found[0]) if found else None


def _unknown_children(parent, known: frozenset[str]) -> list[str] | None:
    """Local names of children that are not known, once per occurrence; None if all are."""
    return [n for child in parent if (n := child.tag.rpartition("}")[2]) not in known] or None


def attribute_field(attribute: str) -> str:
    """Name of the struct field that holds an attribute."""
    return "xml_lang" if attribute == LANG_ATTR else attribute


# Structs are read as tuples in field order; Arrow takes those several times faster
# than dictionaries.


def _element_type(element: str) -> pa.DataType:
    known = [(attribute_field(a), pa.string()) for a in KNOWN_ATTRIBUTES[element]]
    return pa.struct([("text", pa.string()), *known, ("unknown_attributes", _NAMES)])


def _attributes(element: str) -> _Reader:
    """Reader of an element's known attributes and the names of all others."""
    known = KNOWN_ATTRIBUTES[element]
    allowed = frozenset(known)
    nothing = (None,) * (len(known) + 1)

    def read(el) -> tuple:
        names = el.keys()
        if not names:
            return nothing
        unknown = None if allowed.issuperset(names) else [k for k in names if k not in allowed]
        return (*map(el.get, known), unknown)

    return read


def _element(element: str) -> _Reader:
    attributes = _attributes(element)
    return lambda el: (_text(el), *attributes(el))


def _person_type(noun: str, own: list[tuple[str, pa.DataType]]) -> pa.DataType:
    return pa.struct(
        [
            *own,
            ("unknown_children", _NAMES),
            ("name", _element_type(f"{noun}Name")),
            ("given", pa.string()),
            ("family", pa.string()),
            ("name_identifiers", pa.list_(_element_type("nameIdentifier"))),
            ("affiliations", pa.list_(_element_type("affiliation"))),
        ]
    )


def _person(noun: str, known_children: list[str], own: _Reader | None) -> _Reader:
    name_tag, read_name = _kernel(f"{noun}Name"), _element(f"{noun}Name")
    given, family = _kernel("givenName"), _kernel("familyName")
    identifier, read_identifier = _kernel("nameIdentifier"), _element("nameIdentifier")
    affiliation, read_affiliation = _kernel("affiliation"), _element("affiliation")
    known = frozenset(known_children)

    def read(el) -> tuple:
        children = _by_tag(el)
        return (
            *(own(el) if own else ()),
            _unknown_children(el, known),
            _first(children, name_tag, read_name),
            _first(children, given, _text),
            _first(children, family, _text),
            [read_identifier(e) for e in children.get(identifier, ())],
            [read_affiliation(e) for e in children.get(affiliation, ())],
        )

    return read


# Section name -> (Arrow type, reader). A reader gets the root, the resource and the
# grouped children of each; sections of the resource are null if there is none.
_SECTIONS: dict[str, tuple[pa.DataType, _Reader]] = {}


def _unknown_section(name: str, known: list[str], of_root: bool) -> None:
    known_names = frozenset(known)

    def read(root, in_root, res, in_res):
        parent = root if of_root else res
        return None if parent is None else _unknown_children(parent, known_names)

    _SECTIONS[name] = (_NAMES, read)


def _envelope_text(name: str, tag: str) -> None:
    tag = f"{{{ENVELOPE_NS}}}{tag}"
    _SECTIONS[name] = (pa.string(), lambda root, in_root, res, in_res: _first(in_root, tag, _text))


def _single_text(name: str, tag: str) -> None:
    tag = _kernel(tag)
    _SECTIONS[name] = (pa.string(), lambda root, in_root, res, in_res: _first(in_res, tag, _text))


def _single(name: str, element: str) -> None:
    tag, read = _kernel(element), _element(element)
    _SECTIONS[name] = (
        _element_type(element),
        lambda root, in_root, res, in_res: _first(in_res, tag, read),
    )


def count_section(name: str) -> str:
    return f"{name}_count"


def _repeated(name: str, container: str, item: str, item_type: pa.DataType, read: _Reader) -> None:
    """Items of every container of that name, so a second list continues the first.

    Their number is a section of its own, for those who need nothing else of them.
    """
    container, item = _kernel(container), _kernel(item)

    def read_all(root, in_root, res, in_res):
        return None if res is None else [read(el) for p in in_res.get(container, ()) for el in p if el.tag == item]

    def count(root, in_root, res, in_res):
        return sum([len(p.findall(item)) for p in in_res.get(container, ())])

    _SECTIONS[name] = (pa.list_(item_type), read_all)
    _SECTIONS[count_section(name)] = (pa.int64(), count)


def _elements(name: str, container: str, element: str) -> None:
    _repeated(name, container, element, _element_type(element), _element(element))


_unknown_section("unknown_root_children", KNOWN_ROOT_CHILDREN, of_root=True)
_unknown_section("unknown_resource_children", KNOWN_RESOURCE_CHILDREN, of_root=False)
_envelope_text("schema_version", "schemaVersion")
_envelope_text("datacentre_symbol", "datacentreSymbol")
_single("identifier", "identifier")
_elements("alternate_identifiers", "alternateIdentifiers", "alternateIdentifier")
_elements("titles", "titles", "title")
_repeated(
    "creators",
    "creators",
    "creator",
    _person_type("creator", []),
    _person("creator", KNOWN_CREATOR_CHILDREN, None),
)
_repeated(
    "contributors",
    "contributors",
    "contributor",
    _person_type("contributor", [("contributorType", pa.string()), ("unknown_attributes", _NAMES)]),
    _person("contributor", KNOWN_CONTRIBUTOR_CHILDREN, _attributes("contributor")),
)
_elements("subjects", "subjects", "subject")
_elements("dates", "dates", "date")
_single("resource_type", "resourceType")
_elements("related_identifiers", "relatedIdentifiers", "relatedIdentifier")
_elements("rights", "rightsList", "rights")
_elements("descriptions", "descriptions", "description")
_single_text("publisher", "publisher")
_single_text("publication_year", "publicationYear")
_single_text("version", "version")

SECTIONS: list[str] = list(_SECTIONS)

_HEAD = [
    ("path", pa.string()),
    ("file_name", pa.string()),
    ("is_missing", pa.bool_()),
    ("parser_error", pa.string()),
    ("has_resource", pa.bool_()),
]


def _ddl(arrow_type: pa.DataType) -> str:
    if pa.types.is_struct(arrow_type):
        fields = (f"{f.name}: {_ddl(f.type)}" for f in arrow_type)
        return f"struct<{', '.join(fields)}>"
    if pa.types.is_list(arrow_type):
        return f"array<{_ddl(arrow_type.value_type)}>"
    return {pa.bool_(): "boolean", pa.int64(): "bigint"}.get(arrow_type, "string")


# Encodings with more than one byte a letter, which the parser leaves to others.
_DECLARED = re.compile(rb"""^<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)""")


def _parsed(content: bytes) -> ElementTree.Element:
    try:
        return ElementTree.fromstring(content)
    except ValueError:
        declared = _DECLARED.match(content)
        if declared is None:
            raise
        # Text overrides what its own declaration says.
        return ElementTree.fromstring(content.decode(declared[1].decode("ascii")))


def _shred_one(
    path: str, file_name: str, content: bytes | None, readers: Sequence[_Reader]
) -> tuple:
    root = error = None
    if content is not None:
        try:
            root = _parsed(content)
        except (ElementTree.ParseError, LookupError, ValueError) as exc:
            error = str(exc)
    in_root = {} if root is None else _by_tag(root)
    resources = (el for p in in_root.get(_PAYLOAD, ()) for el in p if el.tag == _RESOURCE)
    resource = next(resources, None)
    in_resource = {} if resource is None else _by_tag(resource)
    head = (path, file_name, content is None, error, resource is not None)
    return head + tuple([read(root, in_root, resource, in_resource) for read in readers])


def shred_documents(docs: DataFrame, sections: Sequence[str] = SECTIONS) -> DataFrame:
    """``path, file_name, content`` to one nested row per document.

    A document that cannot be parsed becomes a row with ``parser_error``; it never
    fails the job. Catalyst cannot prune columns that Python makes, so a caller who
    needs only some ``sections`` names them and the others are not built.
    """
    wanted = [name for name in SECTIONS if name in set(sections)]
    fields = [*_HEAD, *((name, _SECTIONS[name][0]) for name in wanted)]

    def shred(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [_SECTIONS[name][1] for name in wanted]
        schema = pa.schema(fields)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
            )

        rows, size = [], 0
        for batch in batches:
            paths, names, contents = (batch.column(i) for i in range(3))
            for path, name, content in zip(paths, names, contents):
                xml = content.as_py()
                rows.append(_shred_one(path.as_py(), name.as_py(), xml, readers))
                size += len(xml or b"")
                if len(rows) >= _BATCH_DOCS or size >= _BATCH_BYTES:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    ddl = ", ".join(f"{name} {_ddl(arrow_type)}" for name, arrow_type in fields)
    return docs.select("path", "file_name", "content").mapInArrow(shred, ddl)
