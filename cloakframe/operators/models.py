"""What calls a language model, with the call given by the user: guess attacks, attacker, rewrite and re-attack, artefact review.

Without a network nothing here can be run against a real model; `ask` is any function from a prompt to an answer. It is called
once a row, in the workers, and a call that fails is a failed row, not a failed job."""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Ask = Callable[[str], str]

#: How much of a masked text is shown to a model.
EXCERPTS, EXCERPT = 3, 2000


def retry_delay(attempt: int, base: float = 1.0, most: float = 60.0, jitter: float = 0.0, after: float | None = None) -> float:
    """Base * 2 ** (attempt - 1), at most `most`, plus up to `jitter`; a server's own delay comes first."""
    if after is not None:
        return min(most, max(0.0, after))
    return min(most, base * 2 ** (attempt - 1)) + random.uniform(0, jitter)


def asked(ask: Ask, prompt: str, attempts: int = 3, base: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """An answer, after a few attempts; the last failure is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return ask(prompt)
        except Exception:  # whatever a client raises
            if attempt == attempts:
                raise
            sleep(retry_delay(attempt, base))
    raise AssertionError


def json_in(answer: str) -> dict | None:
    """The object from the first brace to the last of an answer, fenced or not; None if that is no JSON object."""
    found = re.search(r"\{.*\}", answer or "", re.DOTALL)
    try:
        out = json.loads(found.group()) if found else None
    except ValueError:
        return None
    return out if isinstance(out, dict) else None


def clean_rewrite(answer: str) -> str:
    """An answer without fences and without a first line that announces the text."""
    text = re.sub(r"^\s*```[a-z]*\s*\n|\n\s*```\s*$", "", answer or "").strip()
    return re.sub(r"^(?:here is|here's|sure)[^\n]*:\s*\n+", "", text, flags=re.IGNORECASE).strip()


def guess_prompt(texts: Column, summary: Column, industry: str = "") -> Column:
    """The prompt of the guess attack: up to three excerpts of 2000 characters (texts: array) and a summary as JSON."""
    head = "A privacy audit: name the company that these masked texts may stem from.\n" + (f"Its industry is {industry}.\n" if industry else "")
    head += 'Answer as JSON: {"guesses": [{"rank": 1, "guess": "...", "confidence": 0.0, "clue_types": ["..."]}]}, five at most.\n\n'
    parts = F.transform(F.slice(texts, 1, EXCERPTS), lambda t, i: F.concat(F.lit("Excerpt "), (i + 1).cast("string"), F.lit(":\n"), F.substring(t, 1, EXCERPT), F.lit("\n\n")))
    return F.concat(F.lit(head), F.array_join(parts, ""), F.lit("Summary:\n"), summary, F.lit("\n"))


def answers(prompts: DataFrame, ask: Ask, prompt_col: str = "prompt", attempts: int = 3) -> DataFrame:
    """Rows with `answer` and `error`; a null prompt is not asked."""
    columns = prompts.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for prompt in frame[prompt_col]:
                try:
                    out.append((asked(ask, prompt, attempts), None) if isinstance(prompt, str) else (None, None))
                except Exception as e:  # noqa: BLE001 - a failed call is a row's result
                    out.append((None, type(e).__name__))
            yield frame.assign(answer=[a for a, _ in out], error=[e for _, e in out])

    kinds = ", ".join(f"`{c}` {t}" for c, t in prompts.dtypes)
    return prompts.mapInPandas(run, f"{kinds}, answer string, error string").select(*columns, "answer", "error")


_GUESS = "guesses array<struct<rank:int,guess:string,confidence:double,clue_types:array<string>>>"


def guess_attack(rows: DataFrame, ask: Ask, most: float = 0.7) -> DataFrame:
    """(id, prompt_hash, top_confidence, blocked, guesses) of prompts (id, prompt): guesses keep rank, confidence and kinds
    of clues, not their text. Blocked over `most`, and where no answer can be read."""
    told = answers(rows.select("id", "prompt"), ask)
    found = F.from_json(F.regexp_extract("answer", r"(?s)(\{.*\})", 1), _GUESS)["guesses"]
    shown = F.transform(found, lambda g: F.struct(g["rank"].alias("rank"), F.lit("[REDACTED]").alias("guess"), g["confidence"].alias("confidence"), g["clue_types"].alias("clue_types")))
    top = F.array_max(F.transform(found, lambda g: g["confidence"]))
    return told.select("id", F.substring(F.sha2("prompt", 256), 1, 16).alias("prompt_hash"), top.alias("top_confidence"), (F.coalesce(top > most, F.lit(False)) | found.isNull()).alias("blocked"), shown.alias("guesses"))


def has_direct(found: Mapping[str, object] | None) -> bool:
    """Whether an attacker's result names direct identifiers; one that cannot be read counts as such."""
    return True if found is None else bool(found.get("direct_identifiers"))


def judged(found: Mapping[str, object] | None, secret: str) -> str:
    """FAIL on a right guess, direct identifiers, a confidence over 0.60, or no result; REVIEW from 0.35 or with clues."""
    if found is None or has_direct(found):
        return "FAIL"
    guess, sure = str(found.get("guess") or ""), found.get("confidence")
    sure = float(sure) if isinstance(sure, int | float) else 1.0
    if (secret and secret.lower() in guess.lower()) or sure > 0.60:
        return "FAIL"
    return "REVIEW" if sure >= 0.35 or found.get("leaked_clues") else "PASS"


def attack_and_rewrite(chunks: DataFrame, attack: Ask, rewrite: Ask, secret: str = "", rounds: int = 1) -> DataFrame:
    """(doc_id, chunk, verdict, first_verdict, rewritten, text, parse_error) of chunks (doc_id, chunk, text): an attack, a
    rewrite where that does not pass, and an attack again, `rounds` times at most.

    An empty rewrite keeps the text; a call that fails is a parse error and a FAIL."""

    def one(text: str) -> tuple[str, str, bool, str, bool]:
        try:
            found = json_in(asked(attack, text))
            first = verdict = judged(found, secret)
            changed = False
            for _ in range(rounds):
                if verdict == "PASS":
                    break
                new = clean_rewrite(asked(rewrite, text))
                if not new or new == text:
                    break
                text, changed = new, True
                found = json_in(asked(attack, text))
                verdict = judged(found, secret)
            return verdict, first, changed, text, found is None
        except Exception:  # noqa: BLE001 - a failed call fails the chunk
            return "FAIL", "FAIL", False, text, True

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            done = [one(t or "") for t in frame["text"].astype(object).where(frame["text"].notna(), "")]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "chunk": frame["chunk"], **{n: [d[i] for d in done] for i, n in enumerate(("verdict", "first_verdict", "rewritten", "text", "parse_error"))}})

    kind = chunks.schema["doc_id"].dataType.simpleString()
    return chunks.select("doc_id", F.col("chunk").cast("int").alias("chunk"), "text").mapInPandas(run, f"doc_id {kind}, chunk int, verdict string, first_verdict string, rewritten boolean, text string, parse_error boolean")


def real_risks(risks: Column) -> Column:
    """An array of risks (value, ...) without those whose value is only a pseudonym of the system."""
    from . import residual

    return F.filter(risks, lambda r: ~residual.suppressible(r["value"]))


def repaired(text: Column, risks: Sequence[tuple[str, str]]) -> Column:
    """A text with the values of risks (value, what stands for it) replaced, longest first, in any case."""
    for value, by in sorted(risks, key=lambda r: (-len(r[0]), r[0])):
        if value.strip():
            text = F.regexp_replace(text, rf"(?i)\Q{value}\E", by.replace("\\", r"\\").replace("$", r"\$"))
    return text


def artefact_review(artefacts: DataFrame, ask: Ask) -> DataFrame:
    """(path, risks, needs_repair, status) of public artefacts (path, text): the model's risks without pseudonyms; what
    cannot be read needs repair."""
    prompts = artefacts.select("path", F.concat(F.lit('List values that identify a company or person as JSON: {"risks": [{"value": "...", "kind": "..."}]}.\n\n'), F.coalesce("text", F.lit(""))).alias("prompt"))
    told = answers(prompts, ask)
    found = F.from_json(F.regexp_extract("answer", r"(?s)(\{.*\})", 1), "risks array<struct<value:string,kind:string>>")["risks"]
    left = real_risks(found)
    status = F.when(found.isNull(), "FAILED_PARSE").when(F.size(left) > 0, "NEEDS_REPAIR").otherwise("PASS")
    return told.select("path", F.coalesce(left, F.array().cast("array<struct<value:string,kind:string>>")).alias("risks"), (status != "PASS").alias("needs_repair"), status.alias("status"))


def recognised(docs: DataFrame, load: Callable[[], Callable[[str], list[tuple[int, int, str, float]]]], provider: str = "local") -> DataFrame:
    """(chunk_id, start, end, label, score, provider) of chunks (chunk_id, text) by a recogniser that `load` makes once a
    worker; a text that it cannot do has no spans."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            out = []
            for ident, text in zip(frame["chunk_id"], frame["text"], strict=True):
                try:
                    out += [(ident, *s, provider) for s in (model(text) if isinstance(text, str) else [])]
                except Exception:  # noqa: BLE001 - a text that fails has no spans
                    continue
            yield pd.DataFrame(out, columns=["chunk_id", "start", "end", "label", "score", "provider"])

    return docs.select("chunk_id", "text").mapInPandas(run, "chunk_id string, start int, end int, label string, score double, provider string")
