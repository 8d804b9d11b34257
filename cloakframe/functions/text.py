"""Column functions on text: tokens, detectors, scrubbing, spans. All are JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"
#: Forms of identifiers, in the order in which they are scrubbed, and what stands in for them.
FORMS: tuple[tuple[str, str, str], ...] = (
    ("url", r"https?://[^\s<>\"]+", "[URL]"),
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+", "[EMAIL]"),
    ("secret", r"\b[0-9a-f]{32,64}\b", "[SECRET]"),
    ("phone", r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}", "[PHONE]"),
    ("ipv4", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[IP]"),
    ("number", r"\b\d{13,19}\b", "[NUMBER]"),
)


#: What Unicode calls separators of words (Zs), which SQL trims.
SEPARATORS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def trimmed(text: Column) -> Column:
    """The text without separators at its ends; Spark's own trim takes plain blanks only."""
    return F.trim(text, F.lit(SEPARATORS))


def tokens(text: Column) -> Column:
    """T29."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Every n words in a row, joined by a space."""
    # the outer transform binds the words once; an inner lambda would compute them again for every place
    def of(w: Column) -> Column:
        last = F.size(w) - n + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.array(words), of))


def occurrences(text: Column, value: str) -> Column:
    """How often a literal stands in the text, without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(value), F.lit("")))) / len(value)).cast("long")


def normal(text: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def scrubbed(text: Column, forms: Sequence[tuple[str, str, str]] = FORMS) -> Column:
    """Each form replaced by what stands in for it."""
    for _, pattern, name in forms:
        text = F.regexp_replace(text, pattern, name.replace("$", r"\$"))
    return text


def stripped_html(html: Column) -> Column:
    """Scripts, styles, comments and tags out, four entities back, white space collapsed."""
    for pattern, by in ((r"(?is)<script\b.*?</script>", " "), (r"(?is)<style\b.*?</style>", " "), (r"(?s)<!--.*?-->", " "), (r"<[^>]+>", " "), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), (r"\s+", " ")):
        html = F.regexp_replace(html, pattern, by)
    return F.trim(html)


def literal_spans(text: Column, aliases: Sequence[tuple[str, str, int]]) -> Column:
    """(start, end, alias, by, priority) of every match of literal aliases (value, replacement, priority)."""

    def of(value: str, by: str, priority: int) -> Column:
        parts = F.split(text, F.lit(r"\Q" + value + r"\E"), -1)
        ends = F.aggregate(parts, F.array().cast("array<int>"), lambda a, p: F.concat(a, F.array(F.length(p) + F.when(F.size(a) > 0, F.element_at(a, -1) + len(value)).otherwise(F.lit(0)))))
        return F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: F.struct(e.alias("start"), (e + len(value)).alias("end"), F.lit(value).alias("alias"), F.lit(by).alias("by"), F.lit(priority).alias("priority")))

    return F.flatten(F.array(*[of(*a) for a in aliases]))


def resolved(spans: Column) -> Column:
    """Greedy, by priority, then length, then start, then alias; a span that overlaps an accepted one goes."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct((-s["priority"]).alias("p"), (s["start"] - s["end"]).alias("l"), s["start"].alias("start"), s["alias"].alias("alias"), s["end"].alias("end"), s["by"].alias("by"))))
    empty = F.filter(keyed, lambda s: F.lit(False))
    return F.aggregate(keyed, empty, lambda acc, s: F.when(F.exists(acc, lambda a: (a["start"] < s["end"]) & (a["end"] > s["start"])), acc).otherwise(F.concat(acc, F.array(s))))


def spliced(text: Column, accepted: Column) -> Column:
    """The text with each accepted span replaced."""
    ordered = F.array_sort(F.transform(accepted, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["by"].alias("by"))))
    done = F.aggregate(ordered, F.struct(F.lit("").alias("t"), F.lit(0).alias("at")), lambda a, s: F.struct(F.concat(a["t"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), s["by"]).alias("t"), s["end"].alias("at")))
    return F.concat(done["t"], F.substring(text, done["at"] + 1, F.length(text)))


def chunks(text: Column, size: int, overlap: int) -> Column:
    """T27, fixed: (start, text) of pieces of `size` characters, each beginning `overlap` before the last one's end."""
    step = size - overlap
    count = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / step).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct((i * step).alias("start"), F.substring(text, i * step + 1, F.lit(size)).alias("text")))
