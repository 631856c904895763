"""Links and marked-up fields of HTML pages."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The reader travels with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def attribute_of(html: str | Column, tag: str, attr: str) -> Column:
    """Quoted value of an attribute of the first such element that has it; NULL where none has."""
    column = F.col(html) if isinstance(html, str) else html
    found = F.regexp_extract_all(column, F.lit(rf'(?is)<{tag}\b[^>]*?\s{attr}\s*=\s*"([^"]*)"'), F.lit(1))
    return F.try_element_at(found, F.lit(1))


def links_of(html: str | Column, marker: str | None = None) -> Column:
    """Link targets of a page, all or only those of anchors that carry a marker."""
    column = F.col(html) if isinstance(html, str) else html
    anchors = F.regexp_extract_all(column, F.lit(r"(<a\s[^>]*>)"), F.lit(1))
    if marker is not None:
        anchors = F.filter(anchors, lambda a: F.contains(a, F.lit(marker)))
    targets = F.transform(anchors, lambda a: F.regexp_extract(a, r'\bhref="([^"]+)"', 1))
    return F.filter(targets, lambda t: t != "")


def list_links(pages: DataFrame, html: str = "html", marker: str | None = None, out: str = "link") -> DataFrame:
    """One row per link of every page."""
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.explode(links_of(html, marker)).alias(out))


@dataclass(frozen=True)
class Field:
    """Elements to read: tag, an attribute and what it must hold, what to take."""

    tag: str | None
    attr: str
    value: str | None = None
    part: bool = False
    take: str = "text"
    many: bool = False

    def hits(self, tag: str, attrs: Mapping[str, str | None]) -> bool:
        if self.tag not in (None, tag) or self.attr not in attrs:
            return False
        held = attrs[self.attr] or ""
        return self.value is None or (self.value in held if self.part else self.value == held)


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "em", "i", "label", "mark", "small", "span", "strong", "sub", "sup", "u"}
_HIDDEN = {"script", "style", "template"}


class _Reader(HTMLParser):
    """Collects the visible text or an attribute of the wanted elements."""

    def __init__(self, fields: Mapping[str, Field]):
        super().__init__(convert_charrefs=True)
        self.by_attr: dict[str, list[tuple[str, Field]]] = {}
        for name, field in fields.items():
            self.by_attr.setdefault(field.attr, []).append((name, field))
        self.found: dict[str, list[str]] = {name: [] for name in fields}
        # Open elements, and how many texts were being collected before each.
        self.open: list[tuple[str, int]] = []
        self.texts: list[tuple[str, list[str]]] = []

    def _write(self, text: str) -> None:
        for _, parts in self.texts:
            parts.append(text)

    def handle_starttag(self, tag, attrs):
        if self.texts and tag not in _INLINE:
            self._write("\n")
        before = len(self.texts)
        if attrs:
            held = dict(attrs)
            for attr in held:
                for name, field in self.by_attr.get(attr, ()):
                    if not field.hits(tag, held):
                        continue
                    if field.take == "text":
                        if tag not in _VOID:
                            self.texts.append((name, []))
                    else:
                        self.found[name].append(held.get(field.take) or "")
        if tag not in _VOID:
            self.open.append((tag, before))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if all(t != tag for t, _ in self.open):
            return
        while self.open:
            name, before = self.open.pop()
            for field, parts in self.texts[before:]:
                lines = (" ".join(line.split()) for line in "".join(parts).split("\n"))
                self.found[field].append("\n".join(line for line in lines if line))
            del self.texts[before:]
            if name == tag:
                break
        if self.texts and tag not in _INLINE:
            self._write("\n")

    def handle_data(self, data):
        if self.texts and self.open[-1][0] not in _HIDDEN:
            self._write(" ".join(data.splitlines()) if "\n" in data or "\r" in data else data)


def read_fields(html: str | None, fields: Mapping[str, Field]) -> dict[str, str | None]:
    """Fields of one page; an absent one is ``None``."""
    if html is None:
        return dict.fromkeys(fields)
    reader = _Reader(fields)
    reader.feed(html)
    reader.close()
    while reader.open:
        reader.handle_endtag(reader.open[-1][0])
    return {
        name: ("".join(reader.found[name]) if field.many else reader.found[name][0])
        if reader.found[name]
        else None
        for name, field in fields.items()
    }


def fields_of(html: str | Column, fields: Mapping[str, Field]) -> Column:
    """Struct of the fields of every page, read batch by batch."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])

    @F.pandas_udf(schema)
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([read_fields(page, fields) for page in batch], columns=list(fields))

    # Marked as not repeatable, or a filter on a field would read every page once more.
    return extract.asNondeterministic()(F.col(html) if isinstance(html, str) else html)
