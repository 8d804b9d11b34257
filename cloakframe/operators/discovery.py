"""Residual identifiers: where they stand, how well they are found, and what reviewers decide about them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TITLES = r"(?:CEO|CFO|COO|CTO|CIO|CMO|CHRO|President|Chairman|Vice\s+President|Managing\s+Director|Executive\s+(?:Vice\s+)?President|General\s+Counsel|Chief\s+\w+\s+Officer)"
#: What each detector looks for, and how sure it is.
DETECTORS = (
    ("capitalized_phrase", r"\b(?:[A-Z][a-z]+[']?[a-z]*\s?){2,5}", 0.4),
    ("ticker_pattern", r"\([A-Z]{3,5}\)", 0.6),
    ("url", r"https?://(?:www\.)?[^\s<>\"']+", 0.9),
    ("email", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", 0.9),
    ("executive_pattern", rf"\b{_TITLES}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+", 0.8),
    ("cik", r"(?i)CIK\s*#?\s*\d{6,10}\b", 0.9),
)
#: Exchanges, which are no tickers.
EXCHANGES = ("NYSE", "NASDAQ", "AMEX", "ARCA")
#: A pseudonym, and the mark of a section.
PSEUDONYM, SECTION = r"^[A-Z][a-z]+ \d{3}\b", r"(?i)^(?:Item|Part)\s+\d+[A-Z]?\.?\s*"


def _blanks_of_sql(pattern: str) -> str:
    """The pattern with each \\s as SQL's engine has it: without the vertical tab."""
    blank = r"\t\n\f\r "
    return regex.sub(r"\[(?:\\.|[^\]\\])+\]|\\.", lambda m: m[0].replace(r"\s", blank) if m[0][0] == "[" else f"[{blank}]" if m[0] == r"\s" else m[0], pattern)


def all_spans(text: Column, patterns: Sequence[str], ascii_only: bool = False) -> Column:
    """(pattern, start, end, text) of every match of each pattern that is not empty, in order of pattern and place.

    One Arrow pass for all patterns: Spark's own functions give matches without places, and sums over them are quadratic.
    pattern is the number in `patterns`; places count characters; null and empty texts have no matches. With ascii_only a
    word, a digit and a blank are ASCII's, as in SQL: then a word ends before an umlaut."""
    kind = pa.list_(pa.struct([("pattern", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
    patterns, flags = [_blanks_of_sql(p) if ascii_only else p for p in patterns], regex.ASCII if ascii_only else 0

    def run(column: pa.Array) -> pa.Array:
        compiled = [regex.compile(p, flags) for p in patterns]
        out = []
        for item in column:
            body = item.as_py() or ""
            found = [(i, m.start(), m.end(), m.group()) for i, p in enumerate(compiled) for m in p.finditer(body) if m.end() > m.start()]
            out.append([dict(zip(("pattern", "start", "end", "text"), f, strict=True)) for f in found])
        return pa.array(out, kind)

    return F.arrow_udf(run, "array<struct<pattern:int,start:int,end:int,text:string>>")(F.coalesce(text.cast("string"), F.lit("")))


def spans(text: Column, pattern: str) -> Column:
    """(start, end, text) of all matches of a pattern."""
    return F.transform(all_spans(text, [pattern]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))


def discovered(docs: DataFrame, safe: tuple[str, ...] = (), pseudonyms: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, kind, start, end, found, confidence) of what six detectors find in (doc_id, text).

    Capitalised phrases go if they are short, a pseudonym, the mark of a section, begin with a safe word or have no other;
    tickers go if they are exchanges or safe words. Null texts have none."""

    found = docs.select("doc_id", F.inline(all_spans(F.col("text"), [p for _, p, _ in DETECTORS])))
    kinds, sure = F.array(*[F.lit(k) for k, _, _ in DETECTORS]), F.array(*[F.lit(c) for _, _, c in DETECTORS])
    rows = found.select("doc_id", F.get(kinds, F.col("pattern")).alias("kind"), "start", "end", F.trim("text").alias("found"), F.get(sure, F.col("pattern")).alias("confidence"))
    known = F.array(*[F.lit(w.upper()) for w in safe]).cast("array<string>")
    words = F.split(F.upper(F.regexp_replace("found", "'", "")), r"\s+")
    harmless = (F.length("found") <= 3) | F.col("found").rlike(SECTION) | F.array_contains(known, F.get(words, F.lit(0))) | F.forall(words, lambda w: F.array_contains(known, w))
    named = F.col("found").isin(*pseudonyms) if pseudonyms else F.lit(False)
    ticker = F.regexp_replace("found", "[()]", "")
    dropped = F.when(F.col("kind") == "capitalized_phrase", harmless | named | F.col("found").rlike(PSEUDONYM)).when(F.col("kind") == "ticker_pattern", ticker.isin(*EXCHANGES) | F.array_contains(known, ticker)).otherwise(F.lit(False))
    return rows.filter(~dropped)


def unmasked(found: DataFrame, masked: DataFrame) -> DataFrame:
    """What overlaps no masked range; masked has (doc_id, start, end). A range join within a document."""
    m = masked.select(F.col("doc_id").alias("_doc"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    return found.join(m, (F.col("doc_id") == F.col("_doc")) & (F.col("start") < F.col("_end")) & (F.col("end") > F.col("_start")), "left_anti")


def span_faults(spans_: DataFrame) -> DataFrame:
    """Each span of (text, start, end, score, found) with the first rule that it breaks, or null."""
    reason = (
        F.when(F.col("found").isNull() | F.col("start").isNull() | F.col("end").isNull(), "missing").when((F.col("start") < 0) | (F.col("end") <= F.col("start")), "offsets").when(F.col("end") > F.length("text"), "range")
        .when(F.col("score").isNull() | F.isnan("score") | (F.col("score") < 0) | (F.col("score") > 1), "score").when(F.expr("substring(text, start + 1, end - start)") != F.col("found"), "text mismatch")
    )
    return spans_.withColumn("fault", reason)


def recognised(expected: DataFrame, predicted: DataFrame) -> DataFrame:
    """(kind, expected, exact, relaxed, false_positive, false_negative, precision, recall, f1), and a row of all with kind null.

    Both sides have (doc_id, start, end, kind). Predictions are taken in order of place within a document; each takes the
    first free expected span with its bounds and kind, else the first of its kind that it overlaps. Documents are matched
    apart from one another, so a task holds the spans of one document at a time."""

    def match(spans_: pd.DataFrame) -> pd.DataFrame:
        ordered = spans_.sort_values(["start", "end", "kind"])
        wanted, given = (list(ordered[ordered["wanted"] == side][["start", "end", "kind"]].itertuples(index=False, name=None)) for side in (True, False))
        free, out = [True] * len(wanted), []
        for start, end, kind in given:
            hit = next((i for i, w in enumerate(wanted) if free[i] and w == (start, end, kind)), None)
            how = "exact"
            if hit is None:
                hit = next((i for i, (s, t, k) in enumerate(wanted) if free[i] and k == kind and min(t, end) > max(s, start)), None)
                how = "relaxed" if hit is not None else "false_positive"
            if hit is not None:
                free[hit] = False
            out.append((kind, how))
        out += [(w[2], "false_negative") for w, f in zip(wanted, free, strict=True) if f]
        return pd.DataFrame(out, columns=["kind", "outcome"]).astype(str)

    columns = ["doc_id", "start", "end", "kind"]
    both = expected.select(*columns, F.lit(True).alias("wanted")).unionAll(predicted.select(*columns, F.lit(False).alias("wanted")))
    outcome = both.groupBy("doc_id").applyInPandas(match, "kind string, outcome string")
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    counted = outcome.rollup("kind").agg(n("exact", "relaxed", "false_negative").alias("expected"), n("exact").alias("exact"), n("exact", "relaxed").alias("relaxed"), n("false_positive").alias("false_positive"), n("false_negative").alias("false_negative"))
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    hit = F.col("relaxed")
    out = counted.withColumn("precision", share(hit, hit + F.col("false_positive"))).withColumn("recall", share(hit, hit + F.col("false_negative")))
    return out.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def threshold_sweep(expected: DataFrame, predicted: DataFrame, thresholds: tuple[float, ...] = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """The row of all kinds for each least score; predicted has a score besides."""
    out = None
    for t in thresholds:
        one = recognised(expected, predicted.filter(F.col("score") >= t)).filter("kind is null").drop("kind").withColumn("threshold", F.lit(t))
        out = one if out is None else out.union(one)
    return out


def review_state(decisions: DataFrame) -> DataFrame:
    """The state of each candidate after an append-only log of (seq, candidate_id, decision, reason, kind, value).

    An acceptance without a reason and a kind does not count, nor does an unknown decision; without any that counts a candidate is pending."""
    filled = lambda c: F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
    valid = F.when(F.col("decision") == "accept", filled("reason") & filled("kind")).otherwise(F.coalesce(F.col("decision").isin("reject", "defer", "duplicate"), F.lit(False)))
    last = F.max_by(F.struct("decision", "kind", "value"), F.when(valid, F.col("seq")))
    state = F.create_map(*[F.lit(x) for kv in (("accept", "accepted"), ("reject", "rejected"), ("defer", "deferred"), ("duplicate", "duplicate")) for x in kv])
    out = decisions.groupBy("candidate_id").agg(last.alias("l"), F.count_if(~valid).alias("refused"))
    return out.select("candidate_id", F.coalesce(F.try_element_at(state, F.col("l.decision")), F.lit("pending")).alias("status"), F.col("l.kind").alias("kind"), F.col("l.value").alias("value"), "refused")


def promoted(states: DataFrame, registry: DataFrame, priority: int = 200) -> DataFrame:
    """Accepted values as aliases (kind, value, priority, conflict); a value that the registry has under another kind is a conflict, and under the same kind is left out."""
    key = F.lower(F.trim("value"))
    new = states.filter("status = 'accepted' and value is not null").groupBy("kind", key.alias("key")).agg(F.min("value").alias("value"))
    old = registry.groupBy(key.alias("key")).agg(F.collect_set("kind").alias("kinds"))
    both = new.join(old, "key", "left")
    return both.filter(F.col("kinds").isNull() | ~F.array_contains("kinds", F.col("kind"))).select("kind", "value", F.lit(priority).alias("priority"), F.col("kinds").isNotNull().alias("conflict"))


def latest(rows: DataFrame, group: str, order: Column, keep: int = 1) -> DataFrame:
    """The first `keep` rows of each group in an order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("_n") <= keep).drop("_n")
