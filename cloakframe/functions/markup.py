"""HTML as Markdown, sections of filings, and paragraph chunks: sequential work, done in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is left out, what ends a line, elements without an end, and a filing's item header.
DROPPED = {"script", "style", "noscript"}
VOID = {"br", "img", "meta", "link", "hr", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
ITEM = re.compile(r"\s*(?:ITEM|Item)\s+\d{1,2}[A-Ba-b]?\b[.:\-—–]?\s*.{0,120}$")
ITEM_LINE = r"(?:ITEM|Item)\s+(\d{1,2}[A-Ba-b]?)\b[.:\-—–]?\s*(.*?)$"
LIMIT, CUT = 200_000, "\n\n[... truncated ...]"


class _Tree(HTMLParser):
    """Elements as [name, children]; text as str. End tags without a start are ignored; an open p, li, tr, td or th ends at its next."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[list] = [["", []]]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("p", "li", "tr", "td", "th") and self.stack[-1][0] == tag:
            self.stack.pop()
        node = [tag, []]
        self.stack[-1][1].append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.stack[-1][1].append([tag, []])

    def handle_endtag(self, tag: str) -> None:
        depth = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == tag), 0)
        if depth:
            del self.stack[depth:]

    def handle_data(self, data: str) -> None:
        self.stack[-1][1].append(data)


def _strings(root) -> list[str]:
    """Texts below a node, in order; without recursion, as pages nest at will."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
        elif node[0] not in DROPPED:
            todo.extend(reversed(node[1]))
    return out


def _text(node) -> str:
    return "".join(x.strip() for x in _strings(node))


def _below(root, names: set[str]) -> list:
    out, todo = [], list(reversed(root[1]))
    while todo:
        node = todo.pop()
        if not isinstance(node, str):
            if node[0] in names:
                out.append(node)
            todo.extend(reversed(node[1]))
    return out


def _table(node) -> str:
    rows = [[_text(c).replace("|", "/") for c in _below(r, {"td", "th"})] for r in _below(node, {"tr"})]
    rows = [r for r in rows if any(r)]
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |\n" for r in rows]
    return "\n\n" + lines[0] + "| " + " | ".join(["---"] * width) + " |\n" + "".join(lines[1:])


def _block(name: str, node) -> str | None:
    """What a whole element becomes, or None if its children are to be taken one by one."""
    if name == "br":
        return "\n"
    if name == "table":
        return _table(node)
    text = _text(node) if re.fullmatch(r"h[1-6]|p|b|strong|i|em|li|div", name) else ""
    if name[:1] == "h" and name[1:] in tuple("123456"):
        return f"\n\n{'#' * int(name[1])} {text}\n\n" if text else ""
    if name in ("p", "b", "strong", "div") and text and ITEM.match(text) and (name != "div" or len(text) < 150):
        return f"\n\n## {text}\n\n"
    if name in ("b", "strong"):
        return f"**{text}**" if text else ""
    if name in ("i", "em"):
        return f"*{text}*" if text else ""
    if name == "li":
        return f"\n- {text}" if text else ""
    return None


def to_markdown(html: str | None, limit: int = LIMIT) -> str | None:
    """Headings, paragraphs, emphasis, list items and tables of a page as Markdown; null stays null."""
    if html is None:
        return None
    tree = _Tree()
    tree.feed(html)
    tree.close()
    out, todo = [], [tree.stack[0]]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):  # text that stands after a paragraph
            out.append(node[0])
        elif isinstance(node, str):
            out.append(node.strip() + " " if node.strip() else "")
        elif node[0] not in DROPPED:
            whole = _block(node[0], node)
            if whole is not None:
                out.append(whole)
                continue
            if node[0] == "p":
                out.append("\n\n")
                todo.append(("\n",))
            todo.extend(reversed(node[1]))
    text = re.sub(r"\n{3,}", "\n\n", "".join(out)).strip()
    return text[:limit] + CUT if len(text) > limit else text


def _markdown(html: pd.Series) -> pd.Series:
    return html.map(to_markdown)


def markdown(html: Column | str) -> Column:
    """T21 as a column."""
    return F.pandas_udf(_markdown, "string")(html)


def sections_of(text: str | None) -> list[dict]:
    """Items of a filing: from each item heading to the next, what stands before as `preamble`, or `full` if there is none.

    Plain item lines count only where no heading does. In texts of 200 lines and more, three or more early items less than
    30 lines apart in all (5 on the mean) are a table of contents, if later ones follow."""
    if text is None:
        return []
    lines = text.split("\n")
    found: list[tuple[int, str, str]] = []
    for pattern in (r"#{1,4}\s*" + ITEM_LINE, ITEM_LINE):
        found = [(i, m.group(1).upper(), m.group(2).strip()) for i, line in enumerate(lines) if (m := re.match(pattern, line))]
        if found:
            break
    if len(found) > 3 and len(lines) >= 200:
        cut = max(len(lines) // 5, 50)
        early, late = [f for f in found if f[0] < cut], [f for f in found if f[0] >= cut]
        span = early[-1][0] - early[0][0] if early else 0
        if len(early) >= 3 and late and span < 30 and span / (len(early) - 1) < 5:
            found = late
    if not found:
        return [{"item": "full", "title": "Full Document", "start_line": 0, "end_line": len(lines), "content": text}]
    head = "\n".join(lines[: found[0][0]]).strip()
    out = [{"item": "preamble", "title": "Preamble", "start_line": 0, "end_line": found[0][0], "content": head}] if head else []
    ends = [f[0] for f in found[1:]] + [len(lines)]
    return out + [{"item": f"Item {n}", "title": title, "start_line": i, "end_line": end, "content": "\n".join(lines[i:end]).strip()} for (i, n, title), end in zip(found, ends, strict=True)]


def _sections(text: pd.Series) -> pd.Series:
    return text.map(sections_of)


def item_sections(text: Column | str) -> Column:
    """T23 as a column."""
    return F.pandas_udf(_sections, "array<struct<item:string,title:string,start_line:int,end_line:int,content:string>>")(text)


def paragraph_chunks(text: str | None, size: int, overlap: int) -> list[dict]:
    """Paragraphs packed in order into chunks of at most `size` characters; each begins with the end of the one before.

    A paragraph longer than that is cut at fixed places. Paragraphs are joined by one empty line."""
    out: list[str] = []
    current = ""
    for part in (p for p in re.split(r"\n\s*\n", text or "") if p.strip()):
        if current and len(current) + 2 + len(part) <= size:
            current += "\n\n" + part
            continue
        if current:
            out.append(current)
            tail = current[-overlap:] if 0 < overlap < len(current) else ""
            current = tail + "\n\n" + part if tail and len(tail) + 2 + len(part) <= size else part
        else:
            current = part
        while len(current) > size:
            out.append(current[:size])
            current = current[size - overlap :]
    if current:
        out.append(current)
    return [{"chunk": i, "text": c} for i, c in enumerate(out)]


def paragraph_chunker(size: int = 8000, overlap: int = 500):
    """A column function text -> array of (chunk, text)."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be less than the size")

    def of(text: pd.Series) -> pd.Series:
        return text.map(lambda t: paragraph_chunks(t, size, overlap))

    return F.pandas_udf(of, "array<struct<chunk:int,text:string>>")
