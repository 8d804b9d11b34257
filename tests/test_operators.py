"""Operators on small inputs worked out by hand, or against plain Python."""

from __future__ import annotations

import math
import re
import statistics

from pyspark.sql import functions as F

from cloakframe.functions import series as s
from cloakframe.functions import text as t
from cloakframe.operators import attacks, documents, governance, utility
from cloakframe.sources import files


def test_masking_equals_plain_python(spark):
    aliases = (("Acme Corp", "[A]", 10), ("Acme", "[B]", 20), ("Corp X", "[C]", 10), ("aa", "[D]", 5))
    texts = ["Acme Corp X and Acme", "", "aaa Acme Corp Corp X", "none", "aaaa"]

    def expected(text):
        spans = [(-p, -len(v), m.start(), v, m.end(), by) for v, by, p in aliases for m in re.finditer(re.escape(v), text)]
        kept = []
        for x in sorted(spans):
            if not any(x[2] < k[4] and x[4] > k[2] for k in kept):
                kept.append(x)
        out, at = "", 0
        for x in sorted(kept, key=lambda k: k[2]):
            out, at = out + text[at : x[2]] + x[5], x[4]
        return out + text[at:], len(kept), len(spans) - len(kept)

    got = documents.masked(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), aliases).orderBy("doc_id").collect()
    assert [(r.masked, r.accepted, r.rejected) for r in got] == [expected(x) for x in texts]


def test_quantile_edges_quirk(spark):
    """With fewer values than buckets the first edges are the last value."""
    got = spark.createDataFrame([([1.0, 2.0],), ([float(i) for i in range(10)],)], "x array<double>").select(s.edges(F.col("x"), 5).alias("e")).collect()
    for row, values in zip(got, ([1.0, 2.0], [float(i) for i in range(10)]), strict=True):
        assert row.e == [values[int(len(values) * (i + 1) / 5) - 1] for i in range(5)]


def test_volatility_excludes_the_current_row(spark):
    values = [0.1, -0.2, 0.3, 0.05, 0.0, 0.4]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "entity_id int, bar_idx long, ret double")
    got = [r.v for r in df.select("bar_idx", s.volatility("ret", 3, "bar_idx").alias("v")).orderBy("bar_idx").collect()]
    expected = [0.0] * 3 + [statistics.pstdev(values[i - 3 : i]) for i in range(3, 6)]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, expected, strict=True))


def test_backtest(spark):
    rows = [(1, 0, 1, 0.1), (1, 1, 0, 0.2), (1, 2, 1, -0.3), (1, 3, 1, 0.4)]
    got = utility.backtest(spark.createDataFrame(rows, "entity_id int, bar_idx long, action int, ret double"), cost=0.0).first()
    assert (got.total_return, got.turnover, got.hit_rate) == (0.6, 3, 1.0)


def test_gate_fails_closed(spark):
    schema = "id string, passed boolean, blocking boolean"
    decide = lambda rows: governance.gate(spark.createDataFrame(rows, schema)).first().decision
    assert decide([("a", True, True), ("b", True, False)]) == "PASS"
    assert decide([("a", True, True), ("b", False, False)]) == "REVIEW_REQUIRED"
    assert decide([("a", None, True)]) == "FAIL"
    assert decide([]) == "FAIL"


def test_absent_source_fails(spark):
    ranked = spark.createDataFrame([(i, i) for i in range(1, 40)], "entity_id long, rank int")
    assert governance.privacy_gate(ranked, 99).first().decision == "FAIL"
    assert governance.privacy_gate(ranked, 5).first().decision == "FAIL"
    assert governance.privacy_gate(ranked, 30).first().decision == "PASS"


def test_evidence_and_completeness(spark):
    rows = spark.createDataFrame([("a", 1, 10, 5.0), ("", 0, 10, 5.0), ("b", 3, 2, 500.0)], "key string, rank int, size int, percentile double")
    assert [r.issues for r in governance.evidence_issues(rows).collect()] == ["", "rank,key", "rank,percentile"]
    required, seen = spark.createDataFrame([("a",), ("b",)], "key string"), spark.createDataFrame([("b",), ("c",)], "key string")
    assert {(r.key, r.issue) for r in governance.completeness(required, seen).collect()} == {("a", "missing"), ("c", "unexpected")}


def test_scrub_and_scan(spark):
    text = "Mail a.b@x.example.com or +1 (017) 555-7713 from 10.0.0.1, card 4785380592391135 https://x.y/z?q"
    row = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert row.select(t.scrubbed(F.col("text")).alias("s")).first().s == "Mail [EMAIL] or [PHONE] from [IP], card [NUMBER] [URL]"
    hit = documents.identifier_scan(row).first()
    assert (hit.url, hit.email, hit.phone, hit.ipv4, hit.number, hit.secret) == (1, 1, 1, 1, 1, 0)


def test_ngram_jaccard_of_itself(spark):
    rows = [(e, p, "f", st) for e, sts in ((1, "UDUDF"), (2, "UDUDF"), (3, "FFFFF")) for p, st in enumerate(sts)]
    got = {r.entity_id: r.jaccard for r in attacks.ngram_jaccard(spark.createDataFrame(rows, "entity_id long, period long, feature string, state string"), 1).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0}


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0001234567-24-000001_10-K_2024.md").write_text("# A\nbody")
    (tmp_path / "in" / "tickers.csv").write_text("ticker,enabled\n abc ,true\nxyz,false\nabc,1\n")
    folder = str(tmp_path / "in")
    assert files.read_corpus(spark, folder).first().text == "# A\nbody"
    assert [r.ticker for r in files.read_tickers(spark, f"{folder}/tickers.csv").collect()] == ["ABC"]
    facts = files.inventory(spark, folder).filter(F.col("path").endswith(".md")).first()
    assert (facts.length, facts.form, facts.accession, facts.year) == (8, "10-K", "0001234567-24-000001", 2024)
    assert files.checksums(spark, folder).count() == 2
    files.write_table(spark.range(3), str(tmp_path / "out"), "csv")
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3


def test_stream_bars(spark):
    from cloakframe.streaming import bars as stream

    events = stream.event_stream(spark, "/root/testdata/sf0.001")
    query = stream.tumbling_bars(stream.without_repeats(events)).writeStream.format("memory").queryName("bars_out").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    out = spark.table("bars_out")
    assert out.count() > 0 and out.filter("high < low or high < open or low > close").count() == 0


def test_lagged_copies_are_blocked(spark):
    """A masked series that follows the source a few bars apart is a leak, though all else is unlike."""
    import random

    from cloakframe.operators import attacks

    draw = random.Random(5)
    rows = []
    for entity, lag in enumerate((1, 5, 21, None)):
        own = [draw.gauss(0, 0.01) for _ in range(300)]
        other = [draw.gauss(0, 0.01) for _ in range(300)]
        masked = other if lag is None else own[lag:] + other[:lag]
        rows += [(entity, i, 100.0 + draw.random(), 100.0 + draw.random(), own[i], masked[i]) for i in range(300)]
    out = {r.entity_id: r for r in attacks.structured_attacks(spark.createDataFrame(rows, "entity_id long, bar_idx long, a double, b double, ra double, rb double")).collect()}
    assert [out[k].blocked for k in range(4)] == [True, True, True, False] and all(out[k].direct < 0.5 for k in out)


def test_privacy_gate_rules(spark):
    from cloakframe.operators.governance import privacy_gate

    ranks = spark.range(1, 1001).selectExpr("id AS entity_id", "CAST(id AS INT) AS rank")
    decide = lambda rows, source, **more: privacy_gate(rows, source, **more).first().decision
    assert [decide(ranks, k) for k in (10, 30, 50, 51, 1001)] == ["FAIL", "FAIL", "FAIL", "PASS", "FAIL"]
    assert decide(ranks, 500, reconstructed=True) == decide(ranks, 500, forbidden=("ticker",)) == "FAIL"
    assert decide(ranks.filter("rank <> 7"), 500) == decide(ranks.union(ranks.filter("rank = 500")), 500) == decide(ranks.limit(0), 500) == "FAIL"
