"""Pages rewritten to a small set of tags (C37), with the share of text that is left."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# --- Fixed values: tags that stay, stand for blocks, go with their content, are renamed, or never hold anything ---------
STAY = ("p", "ul", "ol", "li", "h2", "h3", "h4", "strong", "em", "a", "br", "blockquote")
BLOCK = ("p", "ul", "ol", "h2", "h3", "h4", "blockquote")
GO = ("script", "style", "noscript", "head", "meta", "link", "svg", "iframe", "object", "embed")
RENAMED = {"h1": "h2", "h5": "h4", "h6": "h4", "b": "strong", "i": "em"}
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Least share of a page's text that a rewritten page has to keep.
LEAST_COVERAGE = 0.7

NORMAL = T.StructType().add("html", "string").add("text", "string").add("coverage", "double")


class _Events(HTMLParser):
    """A page as a list of (kind, tag or text, href); kind is open, close or text. Tags that do not stay leave their
    content behind; what stands in tags that go is only counted as text of the page. Opening and closing tags match."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, str | None]] = []
        self.open: list[str] = []
        self.gone = 0
        self.raw: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "br" and not self.gone:
                self.events.append(("open", "br", None))
            return
        self.open.append(tag)
        if tag in GO:
            self.gone += 1
        elif not self.gone and (name := RENAMED.get(tag, tag)) in STAY:
            self.events.append(("open", name, dict(attrs).get("href") if name == "a" else None))

    def _close_last(self) -> None:
        tag = self.open.pop()
        if tag in GO:
            self.gone -= 1
        elif not self.gone and (name := RENAMED.get(tag, tag)) in STAY:
            self.events.append(("close", name, None))

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open[-1] != tag:
                self._close_last()
            self._close_last()

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1] in ("script", "style")):
            self.raw.append(data)
        if not self.gone:
            self.events.append(("text", data, None))

    def all(self, html: str) -> list[tuple[str, str, str | None]]:
        self.feed(html)
        self.close()
        while self.open:
            self._close_last()
        return self.events


def _without_empty(events: list[tuple[str, str, str | None]]) -> list[tuple[str, str, str | None]]:
    """Leaves out blocks that hold no text but white space."""
    written, starts, gone = [0], [], []
    for i, (kind, value, _) in enumerate(events):
        written.append(written[-1] + (kind == "text" and bool(value.strip())))
        if kind == "open" and value != "br":
            starts.append(i)
        elif kind == "close":
            start = starts.pop()
            if value in BLOCK and written[i + 1] == written[start]:
                gone.append((start, i))
    out, skip = [], 0
    ends = dict(gone)
    for i, event in enumerate(events):
        if i in ends:
            skip = max(skip, ends[i] + 1)
        if i >= skip:
            out.append(event)
    return out


def _wrapped(events: list[tuple[str, str, str | None]]) -> list[tuple[str, str, str | None]]:
    """Runs of text and inline tags that stand in no block become paragraphs."""
    out, run, depth = [], [], 0
    for event in events:
        kind, value, _ = event
        block = kind != "text" and value in (*BLOCK, "li")
        if depth == 0 and not block:
            if run or kind != "text" or value.strip():
                run.append(event)
            continue
        if run and depth == 0:
            out += [("open", "p", None), *run, ("close", "p", None)]
            run = []
        depth += {"open": 1, "close": -1}[kind] if block else 0
        out.append(event)
    return [*out, ("open", "p", None), *run, ("close", "p", None)] if run else out


def _paragraphs(text: str) -> list[tuple[str, str, str | None]]:
    """Plain text as paragraphs: empty lines part them, or line ends if there are none."""
    parts = [p.strip() for p in re.split(r"\n\s*\n+", text) if p.strip()]
    if len(parts) < 2:
        parts = [p.strip() for p in text.split("\n") if p.strip()]
    return [e for p in parts for e in (("open", "p", None), ("text", p, None), ("close", "p", None))]


def normalised(html: str | None) -> tuple[str, str, float]:
    """(html, text, coverage) of a page. h1 becomes h2, h5 and h6 become h4, b and i become strong and em; other tags but
    those that stay are taken away around their content; attributes go but for links; blocks without text go; text in no
    block becomes paragraphs. The text has the page's words in order. Null and blank pages give empty texts and coverage 1."""
    if not html or not html.strip():
        return "", "", 1.0
    parser = _Events()
    events = parser.all(html)
    if not any(kind == "open" and value in BLOCK for kind, value, _ in events):
        flat = _paragraphs("".join(value for kind, value, _ in events if kind == "text"))
        events = flat if len(flat) > 3 else events
    events = _wrapped(_without_empty(events))
    tag = {"open": lambda v, href: f'<a href="{escape(href)}">' if href is not None else "<br/>" if v == "br" else f"<{v}>", "close": lambda v, _: f"</{v}>\n" if v in (*BLOCK, "li") else f"</{v}>", "text": lambda v, _: escape(v, quote=False)}
    out = re.sub(r"\n\s*\n", "\n", re.sub(r"[ \t]+", " ", "".join(tag[kind](value, href) for kind, value, href in events))).strip()
    text = "\n".join(value for kind, value, _ in events if kind == "text" and value.strip())
    text = re.sub(r"\n\s*\n+", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()
    raw = " ".join(" ".join(parser.raw).split())
    return out, text, len(" ".join(text.split())) / len(raw) if raw else 1.0


@pandas_udf(NORMAL)
def normal_page(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([normalised(h) for h in html], columns=NORMAL.names)
