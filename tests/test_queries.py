"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from cloakframe.functions import grams
from cloakframe.operators import documents
from cloakframe.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(columns)
    return sorted(repr(tuple(v[columns.index(c)] for c in order)) for v in values)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    expected = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(expected.columns, expected.fetchall())


def test_every_sql_has_a_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert registry.FLAGSHIP in registry.QUERIES


def on_texts(spark, folder, name, texts):
    """What a query and its SQL give on documents of (doc_id, text)."""
    folder.joinpath("documents.parquet").mkdir()
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got, expected = registry.QUERIES[name](spark, str(folder)), con.sql(registry.ORACLE_SQL[name])
    return rows(got.columns, [tuple(r) for r in got.collect()]), rows(expected.columns, expected.fetchall())


@pytest.mark.parametrize("text", [
    "Atatsh and Enötz", "xüHe and Erach", "at éacme.com", "Acme\u00a0Widget Inc. of Acme\vCompany", "٢١٢-٥٥٥-٠١٢٣ or 212-555-0123", "http://a.com/x\u00a0 http://b.com/\vx http://\u00a0", "No.\u20031٢-3456", None,
])
def test_harvest_equals_sql_on_other_letters_and_blanks(spark, tmp_path, text):
    got, expected = on_texts(spark, tmp_path, "d04_harvest", [(1, text)])
    assert got == expected


def test_harvest_equals_sql_where_rows_share_an_id(spark, tmp_path):
    got, expected = on_texts(spark, tmp_path, "d04_harvest", [(1, "http://x.io and j@acme.com"), (1, "acme.com"), (2, "Acme and Widget"), (2, "Acme and Widget")])
    assert got == expected


_LONG = "This is a sentence that is long enough to be counted as one of them, and it says here and now what the others say. "


@pytest.mark.parametrize(("text", "kept"), [
    (_LONG * 5 + "5 apples and pears are what this long sentence is about. 6.5 or more of them are what this one is about! ", True),
    (_LONG * 7 + "100 or 7 have no mark behind them in the last sentence of this text 7", True),
    (_LONG * 4 + "\u00a0" + _LONG.replace(". ", ".\u00a0 \u3000 ") * 4, True), (_LONG.replace(" counted", "\vcounted").replace(". ", ".\v") * 9, True),
    (_LONG * 6 + "This one has the tag \u00fcutr:x and is no sentence to be kept. ", True), (_LONG * 2, False), ("", False), (None, False),
])
def test_summary_equals_sql_on_digits_blanks_and_tags(spark, tmp_path, text, kept):
    got, expected = on_texts(spark, tmp_path, "t31_summary", [(1, text)])
    assert got == expected
    assert ("None" not in got[0]) == kept


_PHRASES = [
    (1, "a b c d a b c d e1 e1 e1 e1 e1 e1"), (2, "a b c d once"), (None, "p q r s p q r s"), (3, "p q r s and v w x y"), (None, "v w x y"), (None, "only of rows without an id, only of rows without an id"), (4, "k l m n"), (4, "k l m n"),
    (5, "7 g h i 7 g h i"), (6, "\u00dcber \u0436_\u0663 h i. \u00fcber-\u0436_\u0663, h i"), (7, None), (8, ""), (9, "t t t"), (10, "z z z z z z z"), (11, "y1 z z y1 z z y1 z z"), (12, "y1 z z y1"), (4, "u u u u u"), (None, "a b c d"), (13, "t t t t t t"), (14, "p q r s"), (15, "o p o p o p o"),
]


@pytest.mark.parametrize("few", [{}, {"FIRST_ROUND": 0.05}, {"SHARED_IDS": 0}, {"BLOCK": 5, "FEW_BITS": 8, "MANY_BITS": 8}])
def test_rare_phrases_equal_sql_with_shared_and_missing_ids(spark, tmp_path, monkeypatch, few):
    for name, value in few.items():
        monkeypatch.setattr(grams if hasattr(grams, name) else documents, name, value)
    got, expected = on_texts(spark, tmp_path, "x12_rare_phrases", _PHRASES)
    assert got == expected and len(got) == 12


def test_rare_phrases_of_no_rows(spark, tmp_path):
    got, expected = on_texts(spark, tmp_path, "x12_rare_phrases", [(1, "a b c d"), (2, "")])
    assert got == expected == []


def test_a_second_round_finds_what_others_hide(spark, tmp_path, monkeypatch):
    """The first round's candidates stand in other documents too."""
    monkeypatch.setattr(documents, "FIRST_ROUND", 0.05)
    often = [f"w{i} w{i} w{i} w{i}" for i in range(30)]
    got, expected = on_texts(spark, tmp_path, "x12_rare_phrases", [(i, f"{o} w{i} w{i}") for i, o in enumerate(often)] + [(100 + i, o) for i, o in enumerate(often)] + [(200, "b 2 c d b 2 c d")])
    assert got == expected and len(got) == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_rare_phrases_do_not_shuffle_all_phrases(spark):
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = written()
    assert registry.QUERIES["x12_rare_phrases"](spark, SF).collect()
    assert written() - before < os.path.getsize(f"{SF}/documents.parquet")
