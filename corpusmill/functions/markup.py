"""Arrow UDFs where a parser is needed: any HTML to text, any relative link, rows of a link table."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.text import DATE

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def text_of(html: str, entities: tuple[str, ...] | None = None) -> str:
    """Visible text. References are resolved as browsers do, some without a semicolon too; if ``entities`` are given, only those, whole."""
    parser = _Text()
    parser.feed(re.sub(f"&(?!{'|'.join(re.escape(e.removeprefix('&')) for e in entities)})", "&amp;", html) if entities else html)
    parser.close()
    lines = " ".join(parser.parts).splitlines()
    return " ".join(p for line in lines for p in (q.strip() for q in line.strip().split("  ")) if p)


def parsed_text(html: Column | str, entities: tuple[str, ...] | None = None) -> Column:
    @F.pandas_udf(T.StringType())
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: text_of(page, entities), na_action="ignore")

    return run(html)


@F.pandas_udf(T.StringType())
def joined_url(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([urljoin(b, h) if b is not None and h is not None else None for b, h in zip(base, href, strict=True)])


class _Links(HTMLParser):
    """Anchors in order, each with its section, table row and cell, and surrounding block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.section, self.heading = "", None
        self.anchors, self.open = [], None
        self.rows, self.row, self.blocks, self.block = [], [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3"):
            self.heading = []
        elif tag == "tr":
            self.rows.append([])
            self.row.append(len(self.rows) - 1)
        elif tag == "td" and self.row:
            self.rows[self.row[-1]].append([])
        elif tag in ("p", "div", "li"):
            self.blocks.append([])
            self.block.append(len(self.blocks) - 1)
        elif tag == "a" and dict(attrs).get("href") is not None:
            row = self.row[-1] if self.row else None
            self.open = {"href": dict(attrs)["href"].strip(), "text": [], "section": self.section, "row": row, "cell": len(self.rows[row]) - 1 if row is not None else None, "block": self.block[-1] if self.block else None}
            self.anchors.append(self.open)

    def handle_endtag(self, tag):
        if tag in ("h1", "h2", "h3") and self.heading is not None:
            self.section, self.heading = " ".join(self.heading).strip() or self.section, None
        elif tag == "tr" and self.row:
            self.row.pop()
        elif tag in ("p", "div", "li") and self.block:
            self.block.pop()
        elif tag == "a":
            self.open = None

    def handle_data(self, data):
        word = data.strip()
        if not word:
            return
        if self.heading is not None:
            self.heading.append(word)
        if self.open is not None:
            self.open["text"].append(word)
        if self.row and self.rows[self.row[-1]]:
            self.rows[self.row[-1]][-1].append(word)
        for k in self.block:
            self.blocks[k].append(word)


def link_rows(html: str, base: str) -> list[dict]:
    """Metadata of each download link: from its table row, else from its block and the links before it."""
    page = _Links()
    page.feed(html)
    page.close()
    date = lambda text: (m := re.search(DATE, text)) and m[1] or ""
    out = []
    for k, a in enumerate(page.anchors):
        if " ".join(a["text"]).lower() != "download":
            continue
        if a["row"] is not None:
            cells = [" ".join(c) for c in page.rows[a["row"]]]
            named = next((b for b in page.anchors if b["row"] == a["row"] and b["cell"] in (0, 1) and b["text"]), None)
            day = (date(cells[1]) if len(cells) > 1 else "") or date(" ".join(cells))
        else:
            before = [b for b in page.anchors[max(0, k - 10) : k][::-1] if " ".join(b["text"]).lower() != "download"]
            named = next((b for b in before if b["row"] is None), None) or next((b for b in before if b["text"]), None)
            day = date(" ".join(page.blocks[a["block"]])) if a["block"] is not None else ""
        out.append({"url": urljoin(base, a["href"]), "section": a["section"], "title": " ".join(named["text"]) if named else "", "title_url": urljoin(base, named["href"]) if named else "", "publication_date": day})
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("url", "section", "title", "title_url", "publication_date")])))
def link_table(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([link_rows(h or "", b or "") for h, b in zip(html, base, strict=True)])
