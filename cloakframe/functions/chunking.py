"""Chunks and sections of texts: fixed with word boundaries, by paragraph, by section; longest sections between headings."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNKS = "array<struct<chunk:int,start:int,end:int,text:string,section:string>>"
_SPACE = " \t\n\r"


def next_boundary(text: str, at: int) -> int:
    """Where the next word after a place ends."""
    while at < len(text) and text[at] in _SPACE:
        at += 1
    while at < len(text) and text[at] not in _SPACE:
        at += 1
    return at


def paragraphs(text: str) -> list[tuple[int, str]]:
    """(place, text) of runs of lines that are not blank."""
    return [(m.start(), m.group()) for m in re.finditer(r"[^\n]*\S[^\n]*(?:\n[^\n]*\S[^\n]*)*", text)]


def fixed(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of pieces of `size` characters and the rest of the word there; each begins `overlap` before the last
    one's end (or at it, if that were no progress)."""
    out, at = [], 0
    while at < len(text):
        end = min(at + size, len(text))
        if end < len(text):
            end = max(end, next_boundary(text, end))
        out.append((at, end))
        if end >= len(text):
            break
        at = end - overlap if overlap and end - overlap > at else end
    return out


def by_paragraph(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of whole paragraphs packed in order into `size` characters; one that is longer is cut as `fixed`.

    Places are those of the text, whatever stands between paragraphs; a chunk begins up to `overlap` characters before its
    first paragraph, in the chunk before."""
    out: list[tuple[int, int]] = []
    open_: tuple[int, int] | None = None
    for at, part in paragraphs(text):
        end = at + len(part)
        if open_ and end - open_[0] <= size:
            open_ = (open_[0], end)
            continue
        if open_:
            out.append(open_)
        if len(part) > size:
            out += [(at + a, at + b) for a, b in fixed(part, size, overlap)]
            open_ = None
        else:
            back = max(open_[0] + 1 if open_ else at, at - overlap) if overlap and open_ else at
            open_ = (back if end - back <= size else at, end)
    return out + ([open_] if open_ else [])


def by_section(text: str, sections: Sequence[dict], size: int, overlap: int) -> list[tuple[int, int, str]]:
    """Paragraph chunks of each section (char_start, char_end, title); without sections of the whole text."""
    if not sections:
        return [(a, b, "") for a, b in by_paragraph(text, size, overlap)]
    out = []
    for s in sections:
        first, last = (default if s.get(n) is None or s[n] != s[n] else int(s[n]) for n, default in (("char_start", 0), ("char_end", len(text))))  # pandas makes nulls nan
        out += [(first + a, first + b, s.get("title") or "") for a, b in by_paragraph(text[first:last], size, overlap)]
    return out


def chunker(mode: str = "paragraph", size: int = 2000, overlap: int = 200):
    """A column function (text, sections or nothing) -> array of (chunk, start, end, text, section), numbered from 0.

    mode: `fixed`, `paragraph` or `section` (sections: array of (char_start, char_end, title))."""
    if mode not in ("fixed", "paragraph", "section") or not 0 <= overlap < size:
        raise ValueError("mode must be fixed, paragraph or section, and the overlap less than the size")

    def rows(text: str | None, sections: Sequence[dict] | None) -> list[dict]:
        text = text or ""
        if mode == "section":
            places = by_section(text, list(sections) if sections is not None else [], size, overlap)
        else:
            places = [(a, b, "") for a, b in (fixed if mode == "fixed" else by_paragraph)(text, size, overlap)]
        return [{"chunk": i, "start": a, "end": b, "text": text[a:b], "section": name} for i, (a, b, name) in enumerate(places)]

    def alone(text: pd.Series) -> pd.Series:
        return text.map(lambda t: rows(t, None))

    def both(text: pd.Series, sections: pd.Series) -> pd.Series:
        return pd.Series([rows(t, s) for t, s in zip(text, sections, strict=True)])

    return F.pandas_udf(both if mode == "section" else alone, CHUNKS)


def chunk_rows(docs: DataFrame, mode: str = "paragraph", size: int = 2000, overlap: int = 200, sections_col: str | None = None) -> DataFrame:
    """(doc_id, chunk, start, end, text, section, chunk_id): the id is of the document, the mode and the place, so it
    is the same in every run."""
    of = chunker(mode, size, overlap)
    sections = F.col(sections_col) if sections_col else F.array().cast("array<struct<char_start:int,char_end:int,title:string>>")
    column = of(F.col("text"), sections) if mode == "section" else of(F.col("text"))
    rows = docs.select("doc_id", F.inline(column))
    ident = F.concat(F.lit("chunk-"), F.substring(F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(f"{mode}/{size}/{overlap}"), F.col("start").cast("string")), 256), 1, 12))
    return rows.withColumn("chunk_id", ident)


def section_between(text: Column, start: str, ends: Sequence[str], most: int = 80_000) -> Column:
    """The longest part from a match of `start` to the nearest following match of any of `ends`, in any case, with white
    space collapsed; without an end `most` characters; empty if `start` is not there."""
    flat = F.regexp_replace(text, r"\s+", " ")
    stop = "|".join(f"(?:{e})" for e in ends)
    # the text behind each start, beginning with it
    tails = F.regexp_extract_all(flat, F.lit(rf"(?i)(?=((?:{start})(?s:.*)))(?:{start})"), F.lit(1))

    def cut(tail: Column) -> Column:
        head = F.regexp_extract(tail, rf"(?i)^((?:{start})(?s:.*?))(?:{stop})", 1)
        return F.when(head != "", head).otherwise(F.substring(tail, 1, most))

    parts = F.transform(tails, cut)
    return F.coalesce(F.aggregate(parts, F.lit(""), lambda best, p: F.when(F.length(p) > F.length(best), p).otherwise(best)), F.lit(""))


def section_of(sections: Column, item: str) -> Column:
    """The first section of an item, in any case; null if there is none."""
    return F.get(F.filter(sections, lambda s: F.upper(s["item"]) == item.upper()), F.lit(0))


def section_summary(sections: Column) -> Column:
    """(sections, items, lines, chars) of a document's sections."""
    lines = F.aggregate(sections, F.lit(0), lambda n, s: n + s["end_line"] - s["start_line"])
    chars = F.aggregate(sections, F.lit(0), lambda n, s: n + F.length(s["content"]))
    return F.struct(F.size(sections).alias("sections"), F.array_sort(F.array_distinct(F.transform(sections, lambda s: s["item"]))).alias("items"), lines.alias("lines"), chars.alias("chars"))


def rebuilt(sections: Column, contents: Column) -> Column:
    """Sections with the masked contents in their places; titles and lines stay."""
    return F.transform(sections, lambda s, i: F.struct(s["item"].alias("item"), s["title"].alias("title"), s["start_line"].alias("start_line"), s["end_line"].alias("end_line"), F.coalesce(F.get(contents, i), s["content"]).alias("content")))
