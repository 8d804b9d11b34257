"""Masking by a registry: forms by policy, overlaps, placeholders, and the frame operator."""

from __future__ import annotations

import pytest

from cloakframe.operators.masking import Alias, alias_faults, mask_documents, masker


@pytest.mark.parametrize(
    ("alias", "text", "expected"),
    [
        (Alias("1", "Acme", "[A]"), "Acme, Acmes", "[A], [A]s"),
        (Alias("1", "Acme", "[A]", whole_word=True), "Acme, Acmes", "[A], Acmes"),
        (Alias("1", "IT", "[A]"), "IT WITH IT.", "[A] WITH [A]."),
        (Alias("1", "Acme", None, policy="case_insensitive"), "ACME acme", "[REDACTED] [REDACTED]"),
        (Alias("1", "Acme", "[A]", kind="company"), "see @AcmeCorp", "see [A]"),
        (Alias("1", "abc", "[T]", policy="ticker_exact"), "NYSE: ABC (ABC) ABC abc", "[T] [T] [T] abc"),
        (Alias("1", "abc", "[T]", policy="ticker_parenthesized"), "ABC (ABC)", "ABC [T]"),
        (Alias("1", "0001234567", "[C]", policy="cik_padded"), "CIK # 1234567, 0001234567, 91234567", "[C], [C], 91234567"),
        (Alias("1", "000123456724000001", "[N]", policy="accession_dashed"), "0001234567-24-000001", "[N]"),
        (Alias("1", "x.com", "[D]", policy="domain_full"), "https://www.x.com/a?b or x.com", "https://www.[D]/a?b or [D]"),  # the bare domain has the greater priority
        (Alias("1", "x.com", "[D]", policy="url_full"), "https://www.x.com/a?b or x.com", "[D] or [D]"),
        (Alias("1", "x.com", "[E]", policy="domain_email"), "a.b@x.com x.com", "[E] x.com"),
        (Alias("1", "Acme Corp", "[A]", policy="whitespace_variant"), "Acme\n  Corp", "[A]"),
        (Alias("1", "Acme", "[A]", policy="possessive"), "Acme's and Acme", "[A] and [A]"),
        (Alias("1", "Acme Corp", "[A]", mutations=("dash_variant",)), "Acme-Corp", "[A]"),
        (Alias("1", " ", "[A]"), "a b", "a b"),
    ],
)
def test_forms(alias, text, expected):
    assert masker([alias])(text)[0] == expected


def test_overlaps_and_placeholders():
    aliases = [Alias("1", "Acme", "[A]"), Alias("2", "Acme Corp", "[B]"), Alias("3", "Corp X", "[C]", priority=50), Alias("4", "Company", "[Z]")]
    assert masker(aliases)("Acme Corp X, Acme Corp [Company 001]") == ("[A] [C], [B] [Company 001]", [(0, 4, "1", "literal"), (5, 11, "3", "literal"), (13, 22, "2", "literal")], 2)
    assert masker(aliases)(None) == (None, [], 0) and masker(aliases)("") == ("", [], 0) and masker([])("x") == ("x", [], 0)


def test_frame(spark):
    rows = [(1, "Acme", "x"), (None, None, "x"), (3, "", "x"), (3, "", "x"), (4, "none " * 50_000 + "Acme", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = mask_documents(docs, [Alias("1", "Acme", "[A]")]).collect()
    assert sorted((r.doc_id or 0, (r.masked or "")[-3:], len(r.spans), r.rejected) for r in got) == [(0, "", 0, 0), (1, "[A]", 1, 0), (3, "", 0, 0), (3, "", 0, 0), (4, "[A]", 1, 0)]
    assert mask_documents(docs.limit(0), []).count() == 0


def test_alias_faults(spark):
    aliases = spark.createDataFrame([("a1", "e1", "Acme"), ("a2", "e1", " acme "), ("a3", "e9", "X"), ("a4", "e1", None)], "alias_id string, entity_id string, value string")
    got = {(r.alias_id, r.fault) for r in alias_faults(aliases, spark.createDataFrame([("e1",)], "entity_id string")).collect()}
    assert got == {("a2", "repeated value"), ("a3", "unknown entity"), ("a4", "empty value")}
