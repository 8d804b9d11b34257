"""Private values, files of candidates, and archives on small inputs worked out by hand."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from cloakframe.functions import identity as i
from cloakframe.sources import files


def test_values(spark):
    rows = spark.createDataFrame([("  Acme\n Corp ", "ORG"), ("AB", "TICKER"), ("AB", "ORG"), (" ", "TICKER"), (None, "ORG"), ("ﬁrm “x” — y", "ORG")], "value string, kind string")
    v = F.col("value")
    assert [r.p for r in rows.select(i.private_value(v, F.col("kind"), ("TICKER",)).alias("p")).collect()][:5] == ["Acme Corp", "AB", None, None, None]
    assert rows.select(i.normalized(v).alias("n")).collect()[5].n == 'firm "x" - y' and rows.select(i.normalized(v).alias("n")).collect()[4].n is None
    ids = rows.select(i.opaque("id-", v, F.col("kind")).alias("o")).collect()
    assert len({r.o for r in ids}) == 6 and all(len(r.o) == 15 for r in ids)
    assert rows.limit(1).select(i.collision_key(v).alias("k"), i.path_name(F.lit("a b/c.d")).alias("p")).first()[1] == "a_b/c_d"


def test_redaction(spark):
    rows = spark.createDataFrame([("Acme Corp and ACME, Acmes, C++ (a.b) axb", {"name": "Acme Corp", "id": "Acme"}), (None, None)], "text string, meta map<string,string>")
    text, n = i.stripped_of(F.col("text"), ["Acme", "Acme Corp", "C++", "a.b", ""], "$1")
    got = rows.select(text.alias("t"), n.alias("n"), i.redacted_map(F.col("meta"), ["Acme", "Acme Corp"], ("id",)).alias("m")).collect()
    assert (got[0].t, got[0].n, got[0].m) == ("$1 and $1, Acmes, $1 ($1) axb", 4, {"name": "[REDACTED]", "id": "Acme"})
    assert (got[1].t, got[1].n, got[1].m) == (None, None, None)
    assert rows.select(i.stripped_of(F.col("text"), [])[1].alias("n")).first().n == 0


def test_json_within_text(spark):
    rows = spark.createDataFrame([('Sure:\n```json\n{"a": 1}\n```',), ("none",), ("{broken",), (None,)], "text string")
    assert [r.j and r.j.a for r in rows.select(i.json_within(F.col("text"), "a int").alias("j")).collect()] == [1, None, None, None]


def test_ranges_and_dates(spark):
    row = spark.createDataFrame([(date(2015, 1, 1), date(2024, 2, 29))], "a date, b date")
    got = row.select(i.overlap(F.lit(0), F.lit(5), F.lit(3), F.lit(9)), i.overlap(F.lit(0), F.lit(1), F.lit(3), F.lit(9)), i.spans_years(F.col("a"), F.col("b")), i.spans_years(F.col("a"), F.lit(None).cast("date")), i.lookback(F.col("b"), 1)).first()
    assert tuple(got) == (2, 0, True, False, date(2023, 2, 28))


def test_universe_and_references(spark, tmp_path):
    (tmp_path / "u.json").write_text(json.dumps({"universe_id": "u", "candidates": [{"candidate_id": "a", "returns": [0.1, 0.2], "prices": [1.0, 2.0]}, {"id": "b", "adjusted_returns": [0.3]}, {"id": "c"}]}))
    rows = files.read_universe(spark, str(tmp_path / "u.json"))
    assert sorted(map(tuple, rows.collect())) == [("a", 0, 0.1, 1.0), ("a", 1, 0.2, 2.0), ("b", 0, 0.3, 0.3)]
    reference = spark.createDataFrame([(0, 0.5), (7, 0.5)], "bar_idx long, ret double")
    assert sorted((r.candidate_id, r.bar_idx, r.reference) for r in files.reference_returns(rows, reference).collect()) == [("a", 0, 0.5), ("a", 1, 0.0), ("b", 0, 0.5)]


def test_collected(spark):
    rows = [("p1", "h1", "10-K", 2020, "acc1"), ("p2", "h1", "10-K", 2020, "acc2"), ("p3", "h2", "10-K", 2020, "acc1"), ("p4", "h3", "10-K", 2020, None), ("p5", "h4", "10-K", 2020, None), ("p6", "h5", "8-K", 2020, "acc9")]
    got = files.collected(spark.createDataFrame(rows, "path string, sha256 string, form string, year int, accession string"), ("10-K",), (2020,))
    assert sorted(r.path for r in got.collect()) == ["p1", "p4", "p5"]
