"""Small HTML helpers for use inside tasks, and the Pandas UDFs around them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SILENT = {"script", "style", "template"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
}


class _TextOnly(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.muted = 0

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.muted += 1

    def handle_endtag(self, tag):
        if tag in _SILENT and self.muted:
            self.muted -= 1

    def handle_data(self, data):
        if not self.muted:
            self.parts.append(data)


def text_of(html: str | None) -> str:
    """Text of the markup without tags, comments, scripts and styles."""
    if not html:
        return ""
    parser = _TextOnly()
    parser.feed(html)
    parser.close()
    return "".join(parser.parts)


@F.pandas_udf(T.StringType())
def _html_text_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for html in batches:
        yield html.map(text_of, na_action="ignore")


def html_to_text(html: Column) -> Column:
    """Text of an HTML column. Text without markup or entities stays in the JVM; Python gets null for it."""
    plain = ~html.rlike("[<&]")
    return F.when(html.isNull(), "").when(plain, html).otherwise(_html_text_udf(F.when(~plain, html)))


@dataclass(frozen=True)
class Pick:
    """One field of a row: the element to take it from, and its text or one attribute.

    ``path`` holds ``(tag or None, class or None)`` steps from the row element inwards; the last
    step with ``first_child=True`` must be the first element of its parent.
    """

    name: str
    path: tuple[tuple[str | None, str | None], ...]
    attr: str | None = None
    first_child: bool = False


@dataclass
class _Node:
    tag: str
    classes: frozenset[str]
    attrs: dict[str, str]
    first: bool
    children: int = 0
    text: list[str] = field(default_factory=list)
    fields: dict[str, str] | None = None
    picks: tuple[tuple[dict, str], ...] = ()


class _RowReader(HTMLParser):
    """Collects, for every row element, the first match of each pick."""

    def __init__(self, row: tuple[str | None, str | None], picks: tuple[Pick, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.row, self.picks = row, picks
        self.stack: list[_Node] = []
        self.rows: list[dict[str, str]] = []
        self.muted = 0

    @staticmethod
    def _is(node: _Node, step: tuple[str | None, str | None]) -> bool:
        return (step[0] is None or node.tag == step[0]) and (step[1] is None or step[1] in node.classes)

    def _matches(self, pick: Pick, below: list[_Node]) -> bool:
        if not below or not self._is(below[-1], pick.path[-1]):
            return False
        if pick.first_child:
            # the last step must be a direct, first child of the step before it
            if not below[-1].first or len(pick.path) < 2 or len(below) < 2:
                return False
            if not self._is(below[-2], pick.path[-2]):
                return False
            steps, nodes = list(pick.path[:-2]), below[:-2]
        else:
            steps, nodes = list(pick.path[:-1]), below[:-1]
        for node in reversed(nodes):
            if steps and self._is(node, steps[-1]):
                steps.pop()
        return not steps

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.muted += 1
        values = {k: v or "" for k, v in attrs}
        parent = self.stack[-1] if self.stack else None
        node = _Node(tag, frozenset(values.get("class", "").split()), values, parent is None or parent.children == 0)
        if parent is not None:
            parent.children += 1
        self.stack.append(node)
        if self._is(node, self.row):
            node.fields = {}
            self.rows.append(node.fields)
        taken = []
        for i, owner in enumerate(self.stack[:-1]):
            if owner.fields is None:
                continue
            for pick in self.picks:
                if pick.name not in owner.fields and self._matches(pick, self.stack[i + 1:]):
                    if pick.attr:
                        if pick.attr in values:
                            owner.fields[pick.name] = values[pick.attr]
                    else:
                        owner.fields[pick.name] = ""
                        taken.append((owner.fields, pick.name))
        node.picks = tuple(taken)
        if tag in _VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _close(self) -> None:
        node = self.stack.pop()
        if node.tag in _SILENT and self.muted:
            self.muted -= 1
        for owner, name in node.picks:
            owner[name] = "".join(node.text).strip()
        if self.stack:
            self.stack[-1].text.extend(node.text)

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self.stack):
            while self.stack[-1].tag != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if self.stack and not self.muted:
            self.stack[-1].text.append(data)

    def finish(self) -> list[dict[str, str]]:
        self.close()
        while self.stack:
            self._close()
        return self.rows


def read_rows(html: str | None, row: tuple[str | None, str | None], picks: tuple[Pick, ...]) -> list[dict]:
    if not html:
        return []
    reader = _RowReader(row, picks)
    reader.feed(html)
    return reader.finish()


def html_rows(html: Column, row: tuple[str | None, str | None], picks: tuple[Pick, ...]) -> Column:
    """Array of structs, one per row element of the page, in page order; absent fields are null."""
    names = [p.name for p in picks]
    schema = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))

    @F.pandas_udf(schema)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(
                lambda page: [{n: r.get(n) for n in names} for r in read_rows(page, row, picks)]
            )

    return read(html)
