"""Sequences, discovery, quality, validation and markup on small inputs, against plain Python or results worked out by hand."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cloakframe import __main__ as cli
from cloakframe.functions import markup
from cloakframe.operators import discovery, quality, sequences, validation
from cloakframe.operators.attacks import ORDINALS


def plain_dtw(a, b):
    n, m = len(a), len(b)
    if not n or not m:
        return float("inf")
    band = max(1, min(n, m) // 4)
    cell = {(0, 0): 0.0}
    for i in range(1, n + 1):
        for j in range(max(1, i - band), min(m, i + band) + 1):
            cell[i, j] = abs(a[i - 1] - b[j - 1]) + min(cell.get(c, float("inf")) for c in ((i - 1, j), (i, j - 1), (i - 1, j - 1)))
    return cell.get((n, m), float("inf")) / (n + m)


def plain_transition(a, b):
    states = sorted(set(a) | set(b))

    def matrix(x):
        pairs = list(zip(x, x[1:], strict=False))
        return {(s, t): pairs.count((s, t)) / max(1, sum(p[0] == s for p in pairs)) for s in states for t in states}

    ma, mb = matrix(a), matrix(b)
    return 1 - min(1.0, sum((ma[k] - mb[k]) ** 2 for k in ma) / len(states)) if states else 1.0


def plain_grams(x, n):
    return {tuple(x[i : i + n]) for i in range(len(x) - n + 1)}


def plain_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


SERIES = {1: "UDFUUDFDUDFU", 2: "UDFUUDFDUDFF", 3: "DDDDDDDDDDDD", 4: "UDFUUDFDUD", 5: "FUDFUUDFDUDF", 6: "UDFUUDFDUDFU"}
NAMES = {"U": "UP", "D": "DOWN", "F": "FLAT"}


def as_states(x):
    return [NAMES[c] for c in x]


@pytest.mark.parametrize(("a", "b"), [([], [1.0]), ([1.0], [1.0]), ([1.0, 2.0, 3.0], [1.0, 9.0]), (list(range(30)), [x * 1.1 for x in range(33)]), ([0.5] * 9, [0.1] * 20), ([3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0], [2.0, 7.0, 1.0, 8.0, 2.0, 8.0, 1.0, 8.0])])
def test_warped_distance(a, b):
    import numpy as np

    assert sequences.warped(np.array(a, float), np.array(b, float)) == pytest.approx(plain_dtw(a, b))


def test_attack_suite_equals_plain_python(spark):
    rows = [(e, p, f, NAMES[c]) for e, s in SERIES.items() for f, text in (("weekly_direction_category", s), ("moving_average_regime", s[::-1])) for p, c in enumerate(text)]
    got = {(r.attack_name, r.ablation): r for r in sequences.attack_suite(spark.createDataFrame(rows, "entity_id long, period long, feature string, state string"), 1, top_k=2).collect()}
    assert len(got) == 16

    def measures(a, b):
        n = min(len(a), len(b))
        o, q = ([ORDINALS[x] for x in y] for y in (a, b))
        return {
            "exact": sum(x == y for x, y in zip(a, b, strict=False)) / n, "weighted_hamming": 1 - sum(abs(x - y) / 4 for x, y in zip(o, q, strict=False)) / n, "dtw": 1 / (1 + plain_dtw([x / 4 for x in o], [x / 4 for x in q])),
            "transition": plain_transition(a, b), "ngram": plain_jaccard(plain_grams(a, 3), plain_grams(b, 3)),
        }

    def total(e, lag, features):
        out = {}
        for f in features:
            order = 1 if f == "weekly_direction_category" else -1
            own, other = as_states(SERIES[1][::order]), as_states(SERIES[e][::order])
            for k, v in measures(own[lag:] if lag < len(own) else own, other).items():
                out[k] = out.get(k, 0) + v * (3 if order == 1 else 1)
        weight = sum(3 if f == "weekly_direction_category" else 1 for f in features)
        out = {k: v / max(1, weight) for k, v in out.items()}
        return out | {"combined": sum(out.values()) / 5}

    both = ["weekly_direction_category", "moving_average_regime"]
    for (name, ablation), row in got.items():
        features = {"all": both, "direction": both[:1], "technical_state": both[1:]}.get(ablation)
        if features is None:
            assert (row.true_source_rank, row.status) == (-1, "missing")
            continue
        lag = int(name.split("_")[1]) if name.startswith("lagged_") else 0
        score = {e: round(total(e, lag, features)["combined" if lag else name], 9) for e in SERIES}
        order = sorted(score, key=lambda e: (-score[e], e))
        rank = order.index(1) + 1
        assert (row.true_source_rank, row.candidate_universe_size, row.status) == (rank, 6, "blocked" if rank <= 2 else "completed"), (name, ablation)
        assert row.score == pytest.approx(score[1], abs=1e-6)
        assert row.score_margin == pytest.approx(score[1] - score[order[rank - 2] if rank > 1 else order[1]], abs=2e-6)


def test_attack_suite_without_its_source(spark):
    rows = spark.createDataFrame([(2, 0, "drawdown_bucket", "LOW")], "entity_id long, period long, feature string, state string")
    assert {(r.true_source_rank, r.status) for r in sequences.attack_suite(rows, 1).collect()} == {(-1, "missing")}


def test_spans_have_the_places_of_finditer(spark):
    texts = ["a@b.cd x e@f.gh", "", "no", "é a@b.cd", "a@b.cda@b.cd a@b.cd", None]
    pattern = dict((k, p) for k, p, _ in discovery.DETECTORS)["email"]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", discovery.spans(F.col("text"), pattern).alias("s")).orderBy("i").collect()
    for row, text in zip(got, texts, strict=True):
        assert [(x.start, x.end, x.text) for x in row.s or []] == [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, text or "")]


def test_discovery_and_its_filters(spark):
    docs = spark.createDataFrame([(1, "The Board met. Jane Marlowe Quill (NYSE) (ABCD) CEO Ann Lee; CIK 1234567 Falcon Ridge 123 Item 7"), (2, None)], "doc_id long, text string")
    found = discovery.discovered(docs, safe=("The",))
    got = {(r.kind, r.found) for r in found.collect()}
    assert {("capitalized_phrase", "Jane Marlowe Quill"), ("ticker_pattern", "(ABCD)"), ("executive_pattern", "CEO Ann Lee"), ("cik", "CIK 1234567")} <= got
    assert ("ticker_pattern", "(NYSE)") not in got and ("capitalized_phrase", "The Board") not in got
    masked = found.filter("kind = 'cik'").select("doc_id", "start", "end")
    assert discovery.unmasked(found, masked).filter("kind = 'cik'").count() == 0


def test_recognition_is_greedy_and_one_to_one(spark):
    schema = "doc_id long, start int, end int, kind string, score double"
    expected = spark.createDataFrame([(1, 0, 5, "a", 1.0), (1, 10, 15, "a", 1.0), (2, 0, 3, "b", 1.0), (3, 0, 3, "b", 1.0)], schema)
    predicted = spark.createDataFrame([(1, 0, 5, "a", 0.9), (1, 2, 4, "a", 0.9), (1, 11, 18, "a", 0.5), (2, 0, 3, "a", 0.9), (4, 1, 2, "b", 0.9)], schema)
    got = {r.kind: (r.expected, r.exact, r.relaxed, r.false_positive, r.false_negative) for r in discovery.recognised(expected, predicted).collect()}
    assert got == {"a": (2, 1, 2, 2, 0), "b": (2, 0, 0, 1, 2), None: (4, 1, 2, 3, 2)}
    sweep = {r.threshold: r.relaxed for r in discovery.threshold_sweep(expected, predicted, (0.4, 0.6)).collect()}
    assert sweep == {0.4: 2, 0.6: 1}


def test_span_faults(spark):
    rows = [("abcdef", 0, 3, 0.5, "abc"), ("abcdef", 0, 3, 0.5, "abd"), ("abc", 0, 9, 0.5, "abc"), ("abc", 2, 1, 0.5, "b"), ("abc", 0, 1, 1.5, "a"), ("abc", None, 1, 0.5, "a")]
    got = discovery.span_faults(spark.createDataFrame(rows, "text string, start int, end int, score double, found string")).collect()
    assert [r.fault for r in got] == [None, "text mismatch", "range", "offsets", "score", "missing"]


def test_review_and_promotion(spark):
    log = [(1, "c1", "accept", "", "ORG", "Acme"), (2, "c1", "accept", "seen", "ORG", "Acme"), (3, "c2", "accept", None, "ORG", "X"), (4, "c3", "reject", None, None, None), (5, "c1", "nonsense", "r", "ORG", "Y"), (6, "c4", "accept", "r", "ORG", "Known"), (7, "c5", "accept", "r", "ORG", "Other")]
    states = discovery.review_state(spark.createDataFrame(log, "seq long, candidate_id string, decision string, reason string, kind string, value string"))
    assert {(r.candidate_id, r.status, r.refused) for r in states.collect()} == {("c1", "accepted", 2), ("c2", "pending", 1), ("c3", "rejected", 0), ("c4", "accepted", 0), ("c5", "accepted", 0)}
    registry = spark.createDataFrame([("ORG", " known "), ("PERSON", "other")], "kind string, value string")
    assert {(r.value, r.priority, r.conflict) for r in discovery.promoted(states, registry).collect()} == {("Acme", 200, False), ("Other", 200, True)}


def test_rejection_summary_and_verdict(spark):
    good = "This is a sentence that is long enough to be counted as one of them here and now. " * 8
    tags = good + "\nus-gaap:A\nus-gaap:B\nus-gaap:C"
    rows = spark.createDataFrame([(good,), ("short",), (tags,), (None,), (good.replace(".", ","),)], "text string")
    got = [r.r for r in rows.select(quality.rejection(F.col("text")).alias("r")).collect()]
    assert got == [None, "fewer than 500 meaningful characters", "taxonomy or XBRL noise", "fewer than 500 meaningful characters", "fewer than 5 usable sentences"]
    assert rows.limit(1).select(quality.summary(F.col("text")).alias("s")).first().s == good.strip()
    cases = [(True, False, 0.1, False), (False, False, 0.61, False), (False, False, 0.35, False), (False, False, 0.1, True), (False, False, 0.1, False), (None, False, 0.1, False)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, g boolean, d boolean, c double, l boolean")
    assert [r.v for r in df.orderBy("i").select(quality.verdict(F.col("g"), F.col("d"), F.col("c"), F.col("l")).alias("v")).collect()] == ["FAIL", "FAIL", "REVIEW", "REVIEW", "PASS", "FAIL"]


def test_numbers(spark):
    row = spark.createDataFrame([("$1,200.5 and 3M, 2 billion, 0.5, 7k",)], "text string")
    assert row.select(quality.numbers(F.col("text")).alias("n")).first().n == [1200.5, 3e6, 2e9, 7e3]


def test_markdown():
    html = "<html><script>x()</script><h2>Title <b>x</b></h2><p>One <b>two</b><br>three</p><div>Item 1. Business</div><ul><li>a<li>b</ul><table><tr><th>A<th>B|C</tr><tr><td>1</td></tr></table></html>"
    assert markup.to_markdown(html) == "## Titlex\n\nOne **two**\nthree \n\n\n## Item 1. Business\n\n- a\n- b\n\n| A | B/C |\n| --- | --- |\n| 1 |  |".replace("\n\n\n", "\n\n")
    assert markup.to_markdown("") == "" and markup.to_markdown(None) is None
    assert markup.to_markdown("<p>" + "x" * 50, limit=10) == "x" * 10 + markup.CUT
    assert markup.to_markdown("<div>" * 5000 + "deep") == "deep"


def test_sections():
    assert [s["item"] for s in markup.sections_of("plain")] == ["full"] and markup.sections_of(None) == []
    text = "head\n## Item 1. Business\nbody\n## ITEM 1a Risks\nmore"
    assert [(s["item"], s["title"], s["start_line"], s["end_line"]) for s in markup.sections_of(text)] == [("preamble", "Preamble", 0, 1), ("Item 1", "Business", 1, 3), ("Item 1A", "Risks", 3, 5)]
    contents = "\n".join(["Item 1", "Item 2", "Item 3"] + ["x"] * 200 + ["Item 1", "y"])
    assert [(s["item"], s["start_line"]) for s in markup.sections_of(contents)] == [("preamble", 0), ("Item 1", 203)]


def test_paragraph_chunks():
    assert markup.paragraph_chunks(None, 10, 2) == [] == markup.paragraph_chunks(" \n\n ", 10, 2)
    got = [c["text"] for c in markup.paragraph_chunks("aaaa\n\nbbbb\n \ncccc\n\n" + "d" * 25, 10, 2)]
    assert got[0] == "aaaa\n\nbbbb" and all(len(c) <= 10 for c in got) and set("".join(got)) == set("abcd\n")
    with pytest.raises(ValueError):
        markup.paragraph_chunker(5, 5)


def test_feature_and_submission_faults(spark):
    wide = spark.createDataFrame([(1, 0, "UP", 1.5), (1, 0, "SIDEWAYS", 2.0), (1, 1, None, None)], "entity_id long, relative_week long, weekly_direction_category string, close double")
    got = sorted((r.entity_id or 0, r.fault, r.detail) for r in validation.feature_faults(wide, "relative_week").collect())
    assert got == sorted([(0, "forbidden name", "close"), (1, "continuous value", "close"), (1, "unknown state", "weekly_direction_category=SIDEWAYS"), (1, "repeated period", "relative_week"), (1, "repeated period", "relative_week")])
    rows = spark.createDataFrame([(1, 0, 5, 1), (1, 1, 5, 2), (2, 0, 1, 0), (9, 0, 1, 1)], "submission_id long, pos int, period int, action int")
    found = {(r.submission_id, r.fault) for r in validation.submission_faults(rows, spark.createDataFrame([(1, 1), (2, 5), (3, 5)], "submission_id long, periods int")).collect()}
    assert found == {(1, "more periods than returns"), (1, "invalid action"), (1, "periods do not increase"), (3, "no periods"), (9, "unknown submission")}


def test_utility_of_itself(spark):
    rows = spark.createDataFrame([(1, p, s, "HIGH") for p, s in enumerate(("UP", "DOWN", "UP"))], "entity_id long, relative_week long, weekly_direction_category string, momentum_4w_bucket string")
    got = validation.feature_utility(rows, rows, "relative_week").first()
    assert (got.overall_utility, got.binary_decision_agreement, got.period_retention, got.change_rate) == (1.0, 1.0, 1.0, 0.5)


def test_filings_and_atlas(spark):
    rows = spark.createDataFrame([("10-K", "2024-02-01", "2023-12-31"), ("10-K", "2024-05-01", ""), ("8-K", "2024-05-02", "2024-05-01")], "form string, filingDate string, reportDate string")
    assert validation.filings(rows, form="10-K", year=2023).count() == 1
    assert validation.filings(rows, quarter=2).count() == 2 and validation.filings(rows, first="2024-05-01", last="2024-05-01").count() == 1
    entries = spark.createDataFrame([("names", "legal"), ("names", "short")], "category string, sub_type string")
    got = {r.category: (r.score, r.missing) for r in validation.atlas_coverage(entries, {"names": ("legal", "brand"), "places": ("city",)}).collect()}
    assert got == {"names": (0.5, ["brand"]), "places": (0.0, ["city"])}


def test_command_line(capsys, tmp_path):
    assert cli.main(["list"]) == cli.OK and "x06_s3c_blocks" in capsys.readouterr().out
    assert cli.main(["run", "nothing", "--input", "a", "--output", "b"]) == cli.BAD_INPUT
    assert cli.main(["hash-file", str(tmp_path / "none")]) == cli.BAD_INPUT
    (tmp_path / "a.json").write_text('{"b": 1, "a": 2}')
    (tmp_path / "b.json").write_text('{"a":2,"b":1}')
    capsys.readouterr()
    assert cli.main(["hash-json", str(tmp_path / "a.json")]) == cli.main(["hash-json", str(tmp_path / "b.json")]) == cli.OK
    first, second = capsys.readouterr().out.split()
    assert first == second
