"""Pages to text: visible text, tables of contents, entities, escapes."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: What a tag does to the text around it: its content is hidden, it begins and ends a line, or it parts cells of a row.
EFFECTS = {
    **dict.fromkeys(("script", "style", "noscript"), "hide"), "td": "cell", "th": "cell",
    **dict.fromkeys("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr ul".split(), "line"),
}


class _Events(HTMLParser):
    """A page as a flat list of (kind, tag or text, attributes)."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, dict]] = []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.events.append(("open", tag, dict(attrs)))

    def handle_startendtag(self, tag, attrs):
        self.events += [("open", tag, dict(attrs)), ("close", tag, {})]

    def handle_endtag(self, tag):
        self.events.append(("close", tag, {}))

    def handle_data(self, data):
        self.events.append(("text", data, {}))


def html_text(page: str | None) -> str:
    """Visible text: a line for each block, a blank between cells, blanks collapsed, empty lines dropped."""
    out, hidden = [], 0
    for kind, value, _ in _Events(page or "").events:
        effect = EFFECTS.get(value) if kind != "text" else None
        if effect == "hide":
            hidden = max(0, hidden + (1 if kind == "open" else -1))
        elif kind == "text" and not hidden:
            out.append(value)
        elif effect:
            out.append("\n" if effect == "line" else " ")
    lines = (" ".join(line.split()) for line in "".join(out).split("\n"))
    return "\n".join(line for line in lines if line)


def contents(page: str | None) -> list[tuple[str, str, str]]:
    """(id, title, folders) of each article link of a nested list; the first of an id counts.

    A folder is a ``span`` of class ``folder`` in a list item, an article an ``a`` of class ``linkMateria``.
    """
    out: dict[str, tuple[str, str, str]] = {}
    items: list[str] = []  # the folder of each open list item
    reading, text, link = "", "", ""
    for kind, value, attrs in _Events(page or "").events:
        names = (attrs.get("class") or "").split()
        if kind == "text":
            text += value if reading else ""
        elif kind == "open" and value == "li":
            items.append("")
        elif kind == "close" and value == "li" and items:
            items.pop()
        elif kind == "open" and (value == "span" and "folder" in names or value == "a" and "linkMateria" in names):
            reading, text, link = value, "", attrs.get("identificador") or attrs.get("data-id") or attrs.get("id") or attrs.get("href") or ""
        elif kind == "close" and value == reading:
            title, reading = " ".join(text.split()), ""
            if value == "span" and items:
                items[-1] = title
            elif value == "a" and link:
                out.setdefault(link, (link, title, " / ".join(x for x in items if x)))
    return list(out.values())


@F.pandas_udf(StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    return pages.map(html_text)


@F.pandas_udf(ArrayType(StructType([StructField(c, StringType()) for c in ("id", "titulo", "pasta")])))
def html_contents(pages: pd.Series) -> pd.Series:
    return pages.map(contents)


@F.pandas_udf(StringType())
def unescape_html(values: pd.Series) -> pd.Series:
    """Tags to blanks, entities resolved, blanks collapsed."""
    return values.fillna("").map(lambda v: " ".join(html.unescape(re.sub(r"<[^>]*>", " ", v)).split()))


@F.pandas_udf(StringType())
def repair_escapes(values: pd.Series) -> pd.Series:
    """``/Uhhhh`` as the character it stands for."""
    return values.fillna("").map(lambda v: re.sub(r"/U([0-9A-Fa-f]{4})", lambda m: chr(int(m.group(1), 16)), v))


def before_town_hall(text: str | None, least: float = 0.45) -> str:
    """Text up to the first line that opens a town hall's part, if that lies behind ``least`` of it."""
    text = text or ""
    for m in re.finditer(r"(?im)^[ \t]*prefeitura[ \t]+municipal[ \t]+de\b", text):
        if m.start() >= least * len(text):
            return text[: m.start()].rstrip()
    return text


@F.pandas_udf(StringType())
def state_part(values: pd.Series) -> pd.Series:
    return values.map(before_town_hall)
