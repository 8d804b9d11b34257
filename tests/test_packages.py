"""Archives, packages, checkpoints and configuration on small folders."""

from __future__ import annotations

import hashlib
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from cloakframe.sources import archives, packages


@pytest.fixture
def archive(tmp_path):
    root = tmp_path / "archive"
    (root / "ABC").mkdir(parents=True)
    (root / "ABC" / "10-K_2020_0001234567-20-000001.html").write_text("one")
    (root / "ABC" / "copy_10-K_2020.html").write_text("one")
    (root / "big.txt").write_bytes(b"a" * 200_000)
    with zipfile.ZipFile(root / "more.zip", "w") as z:
        z.writestr("XY/10-Q_2019.htm", "zip")
        z.writestr("dir/", "")
    with tarfile.open(root / "old.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("QR/8-K_1980_2001.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"tar"))
    (root / "broken.zip").write_bytes(b"no zip")
    return root


def test_inventory(spark, archive):
    rows = {r.path: r for r in archives.inventory(spark, str(archive)).collect()}
    assert set(rows) == {"ABC/10-K_2020_0001234567-20-000001.html", "ABC/copy_10-K_2020.html", "big.txt", "XY/10-Q_2019.htm", "QR/8-K_1980_2001.txt"}
    k = rows["ABC/10-K_2020_0001234567-20-000001.html"]
    assert (k.ticker, k.form, k.year, k.accession, k.document, k.archive) == ("ABC", "10-K", 2020, "0001234567-20-000001", "10-K_2020_0001234567-20-000001.html", None)
    assert (rows["QR/8-K_1980_2001.txt"].year, rows["XY/10-Q_2019.htm"].form) == (2001, "10-Q") and rows["XY/10-Q_2019.htm"].archive.endswith("more.zip")
    assert rows["big.txt"].hash == hashlib.sha256(b"a" * 65536 + b"a" * 65536 + b"200000").hexdigest() and k.hash == hashlib.sha256(b"one3").hexdigest()
    kept = [r.path for r in archives.collected(archives.inventory(spark, str(archive)), "abc", ("10-k",), 2000).collect()]
    assert kept == ["ABC/10-K_2020_0001234567-20-000001.html"]
    assert {(r.path, bytes(r.content)) for r in archives.members(spark, str(archive), read=True).collect()} == {("XY/10-Q_2019.htm", b"zip"), ("QR/8-K_1980_2001.txt", b"tar")}


def test_recorded_answers(spark, tmp_path):
    recent = {"accessionNumber": ["a", "b", "c"], "filingDate": ["2020-01-01", "2020-02-01"], "form": ["10-K", "10-Q", "10-K"], "primaryDocument": ["p"]}
    (tmp_path / "submissions-CIK0000000042.json").write_text(json.dumps({"cik": "42", "filings": {"recent": recent}}))
    (tmp_path / "submissions-CIK0000000042-001.json").write_text(json.dumps({k: v[:1] for k, v in recent.items()}))
    (tmp_path / "company_tickers.json").write_text(json.dumps({"0": {"cik_str": 42, "ticker": "abc", "title": "A"}}))
    rows = archives.filings_of(archives.transport(spark, str(tmp_path), "submissions"), ("10-K",))
    assert sorted((r.cik, r.accessionNumber, r.filingDate) for r in rows.collect()) == [("0000000042", "a", "2020-01-01"), ("0000000042", "a", "2020-01-01"), ("0000000042", "c", "")]
    assert archives.filings_of(archives.transport(spark, str(tmp_path), "submissions"), limit=1).count() == 2
    assert archives.resolved_cik(archives.transport(spark, str(tmp_path), "tickers"), "ABC").first().cik == "0000000042"
    with pytest.raises(ValueError):
        archives.transport(spark, str(tmp_path), "submissions", mode="live")


def test_html_and_datasets(spark, tmp_path):
    (tmp_path / "a.html").write_text("<script>x</script><p>some  text</p>")
    assert [tuple(r) for r in archives.read_html_corpus(spark, str(tmp_path), 6).collect()] == [("a.html", "some t")]
    spark.range(3).write.parquet(str(tmp_path / "run" / "one"))
    assert archives.read_datasets(spark, str(tmp_path / "run")).count() == 3


def test_atomic_writes_and_sidecars(tmp_path):
    p = packages.write_json(tmp_path / "d" / "x.json", {"b": 1, "a": [2]})
    assert json.loads(p.read_text()) == {"a": [2], "b": 1} and p.read_text().index('"a"') < p.read_text().index('"b"') and list(p.parent.iterdir()) == [p]
    assert packages.write_lines(tmp_path / "l.jsonl", [{"b": 1, "a": 2}, 3]).read_text() == '{"a":2,"b":1}\n3\n'
    side = packages.write_sidecar(p)
    assert side.read_text() == f"{hashlib.sha256(p.read_bytes()).hexdigest()}  x.json\n" and packages.valid_sidecar(p)
    p.write_text("changed")
    assert not packages.valid_sidecar(p)
    side.write_text("bad")
    with pytest.raises(ValueError):
        packages.valid_sidecar(p)
    with pytest.raises(FileNotFoundError):
        packages.valid_sidecar(tmp_path / "l.jsonl")


def test_packages(spark, tmp_path):
    root = tmp_path / "pkg"
    packages.write_bytes(root / "data" / "ABC.md", b"text about it")
    packages.write_bytes(root / "originals" / "p.md", b"private")
    packages.write_bytes(root / "a.pyc", b"")
    assert packages.public_files(root) == ["data/ABC.md"]
    packages.write_checksums(root)
    assert {r.path for r in packages.package_inventory(spark, str(root)).collect()} == {"data/ABC.md", "checksums.sha256"}
    before = packages.semantic_hash(root)
    target = packages.write_zip(root, tmp_path / "out.zip", {"ABC": "TKR_1"}, packages.leaking(["Acme"]))
    assert zipfile.ZipFile(target).namelist() == ["checksums.sha256", "data/TKR_1.md"] and packages.semantic_hash(root) == before
    again = packages.write_zip(root, tmp_path / "again.zip", {"ABC": "TKR_1"})
    assert again.read_bytes() == target.read_bytes()
    packages.write_bytes(root / "data" / "b.md", b"by Acme")
    with pytest.raises(ValueError, match="leaks"):
        packages.write_zip(root, tmp_path / "bad.zip", {}, packages.leaking(["Acme"]))
    assert not (tmp_path / "bad.zip").exists() and not (tmp_path / "bad.zip.staged").exists() and packages.semantic_hash(root) != before


def test_dossier_and_classroom(spark, tmp_path):
    reports = {"release_decision": {"decision": "PASS"}}
    assert packages.write_dossier(tmp_path / "d", "Company 001", "v1", "p1", reports, ["few weeks"], "s3b_weekly_features") == []
    (tmp_path / "d" / "manifest.json").write_text('{"x": "SRC_001"}')
    (tmp_path / "d" / "attack_summary.json").unlink()
    assert packages.dossier_faults(tmp_path / "d") == ["missing attack_summary.json", "SRC_001 in manifest.json", "checksum of manifest.json"]
    with pytest.raises(ValueError):
        packages.write_dossier(tmp_path / "e", "c", "v", "p", {}, variant="s2_privacy")
    features = spark.createDataFrame([(1, "UP"), (0, "DOWN")], "relative_week int, direction string")
    packages.write_classroom(tmp_path / "c", features, {"rank": 40}, 4)
    assert json.loads((tmp_path / "c" / "example_submission.json").read_text()) == {"binary_actions": [0, 1, 0, 1], "relative_periods": [0, 1, 2, 3]} and json.loads((tmp_path / "c" / "features.json").read_text())[0]["direction"] == "DOWN"
    packages.write_features(features, str(tmp_path / "f"), "relative_week", ["acme"])
    assert spark.read.option("header", True).csv(str(tmp_path / "f")).columns == ["relative_week", "direction"]
    with pytest.raises(ValueError):
        packages.write_features(features.withColumn("x", F.lit("by ACME")), str(tmp_path / "g"), "relative_week", ["acme"])
    assert not (tmp_path / "g").exists()


def test_manifests():
    m = packages.manifest("ABC_prices", "s", "x/ABC.csv", 3, "h", "run1", "ABC")
    assert "ABC" not in m["artifact_id"] + m["relative_output_path"]
    a, b = packages.run_manifest("r1", "c", {"qa": [m | {"generated_at": 1}]}), packages.run_manifest("r2", "c", {"qa": [m | {"generated_at": 2, "run_id": "r2"}]})
    assert a["semantic_hash"] == b["semantic_hash"] != packages.run_manifest("r1", "d", {})["semantic_hash"]


def test_checkpoints(tmp_path):
    art = packages.write_bytes(tmp_path / "a.txt", b"1")
    state = lambda i="i", c="c", v="v": packages.checkpoint_state(tmp_path, "C1", "s", i, c, v)
    assert state() == "none"
    path = packages.save_checkpoint(tmp_path, "C1", "s", "i", "c", "v", [art])
    assert [state(), state(v="w"), state(i="j"), state(c="d")] == ["valid", "version_changed", "input_changed", "config_changed"]
    art.write_text("2")
    assert state() == "artifact_changed"
    art.unlink()
    assert state() == "missing_artifact"
    path.write_text("{")
    with pytest.raises(ValueError):
        state()
    ran = []

    def stage(name):
        def run():
            ran.append(name)
            return [packages.write_bytes(tmp_path / name, name.encode())]

        return name, run

    stages = [stage("one"), stage("two")]
    assert packages.resumed(tmp_path, "C2", stages, "i", "c", "v") == ["one", "two"] and packages.resumed(tmp_path, "C2", stages, "i", "c", "v") == []
    (tmp_path / "two").write_text("x")
    assert packages.resumed(tmp_path, "C2", stages, "i", "c", "v") == ["two"] and packages.resumed(tmp_path, "C2", stages, "j", "c", "v") == ["one"]


def test_guards(tmp_path, monkeypatch):
    assert packages.decision_or_fail(tmp_path / "d.json")["decision"] == "FAIL" and packages.decision_or_fail(tmp_path / "d.json")["decision"] == "FAIL"
    packages.write_json(tmp_path / "d.json", {"decision": "PASS"})
    assert packages.decision_or_fail(tmp_path / "d.json") == {"decision": "PASS"} and packages.evidence_hash(tmp_path / "none") == "placeholder"
    repo = tmp_path / "repo"
    repo.mkdir()
    assert packages.private_root(tmp_path / "priv", repo).is_dir()
    for bad in (repo, repo / "x"):
        with pytest.raises(ValueError):
            packages.private_root(bad, repo)
    assert packages.under(repo, "a/b") == repo.resolve() / "a" / "b"
    with pytest.raises(ValueError):
        packages.under(repo, "../x")
    config = packages.write_bytes(tmp_path / "c.yaml", b"companies: {C1: {source_identity: '${SOME_NAME}'}}")
    with pytest.raises(ValueError, match="SOME_NAME"):
        packages.load_companies(config)
    monkeypatch.setenv("SOME_NAME", "S1")
    assert packages.load_companies(config) == {"C1": {"source_identity": "S1"}}
    packages.write_bytes(tmp_path / "c.yaml", b"companies: {C1: {ticker: A}}")
    with pytest.raises(ValueError, match="identity"):
        packages.load_companies(config)


def run(*argv, capsys=None):
    from cloakframe.__main__ import main

    code = main(list(map(str, argv)))
    return code, capsys.readouterr().out if capsys else ""


def prices(folder, name, closes):
    rows = [{"date": f"d{i}", "open": c, "high": c * 1.01, "low": c * 0.99, "close": c, "volume": 10 + i % 7} for i, c in enumerate(closes)]
    packages.write_json(folder / name, {"records": rows})


def test_command_line_over_texts(spark, tmp_path, capsys):
    from tests.test_privacy import YAML

    reg = packages.write_bytes(tmp_path / "r.yaml", YAML.split("  - {alias_id: 4")[0].encode())
    bad = packages.write_bytes(tmp_path / "bad.yaml", b"entities: []")
    html, text = tmp_path / "html", tmp_path / "text"
    packages.write_bytes(html / "a.html", b"<p>Acme's plan, CIK 0000320193</p><h2>Item 1. Business</h2><p>We sell.</p>")
    packages.write_bytes(text / "a.md", b"Acme Corp sells, call (212) 555-0123")
    assert run("registry-validate", reg, capsys=capsys)[0] == 0 and run("registry-validate", bad, capsys=capsys)[0] == 2 and run("registry-inventory", reg)[0] == 0
    assert run("scan", text, reg)[0] == 3 and run("mask", text, bad)[0] == 2 and run("mask", text, reg, "--output", tmp_path / "m")[0] == 0
    assert spark.read.parquet(str(tmp_path / "m")).first().text == "Company 001 sells, call (212) 555-0123" or "Acme" not in spark.read.parquet(str(tmp_path / "m")).first().text
    for command in ("atlas-harvest", "discover", "chunk", "ingest", "submission"):
        assert run(command, text, "--output", tmp_path / command)[0] == 0, command
    assert run("extract", html, "--output", tmp_path / "x")[0] == 0 and spark.read.parquet(str(tmp_path / "x")).filter("item = 'Item 1'").count() == 1
    code, out = run("reanonymize-run", html, reg, tmp_path / "work", capsys=capsys)
    assert code == 0 and json.loads(out.strip().splitlines()[-1])["decision"] == "PASS" and json.loads((tmp_path / "work" / "decision.json").read_text())["stages_run"] == ["extract", "mask"]
    assert run("reanonymize-run", html, reg, tmp_path / "work")[0] == 0 and json.loads((tmp_path / "work" / "decision.json").read_text())["stages_run"] == []
    assert run("reanonymize-run", html, bad, tmp_path / "none")[0] == 2 and json.loads((tmp_path / "none" / "decision.json").read_text())["decision"] == "FAIL"
    assert run("release-export", text, tmp_path / "o.zip", reg)[0] == 3 and run("registry-validate", tmp_path / "nowhere")[0] == 2
    assert run("boundary-diag", tmp_path / "p", tmp_path / "q")[0] == 0 and run("boundary-diag", tmp_path, tmp_path)[0] == 2 and run("campaign", bad)[0] == 2
    atlas = packages.write_json(tmp_path / "atlas.json", {"entries": [{"entry_id": "1", "category": "issuer", "sub_type": "ticker", "private_value": "ABC"}]})
    assert run("identities-compile", atlas)[0] == 2


def test_command_line_over_series(spark, tmp_path, capsys):
    import numpy as np

    rng = np.random.default_rng(3)
    folder, other = tmp_path / "prices", tmp_path / "masked"
    for i in range(12):
        prices(folder, f"p{i}.json", (100 * np.exp(np.cumsum(rng.normal(0, 0.02, 300)))).tolist())
    prices(other, "p0.json", (100 * np.exp(np.cumsum(rng.normal(0, 0.02, 300)))).tolist())
    assert run("structured-transform", folder, "s1", "--output", tmp_path / "s1")[0] == 0 and run("structured-transform", folder, "zz")[0] == 2
    assert run("s3-transform", folder, "s3a")[0] == 5 and run("s3-transform", folder, "s3b", "--output", tmp_path / "s3b")[0] == 0
    assert run("s3-attack", folder, "s3b", "nobody")[0] == 2 and run("attack-run", folder, folder)[0] == 3 and run("utility-evaluate", folder, other)[0] == 0
    policy = packages.write_json(tmp_path / "policy.json", {"required_attack_keys": ["exact/all"]})
    assert run("pilot-run", folder, "s3b", "p0.json", policy, tmp_path / "pilot")[0] == 2  # the suite holds more than the policy asks for
    from cloakframe.operators.sequences import SUITE

    policy = packages.write_json(tmp_path / "policy.json", {"required_attack_keys": list(SUITE)})
    code, out = run("pilot-run", folder, "s3b", "p0.json", policy, tmp_path / "pilot", capsys=capsys)
    decision = json.loads((tmp_path / "pilot" / "decision.json").read_text())
    assert code == 3 and decision["decision"] == "FAIL" and decision["reasons"] == ["source near the top"]
    assert run("s3-assess", tmp_path / "pilot" / "evidence.jsonl", "s1_basic", policy)[0] == 5
    truth = packages.write_json(tmp_path / "truth.json", {"period_returns": [0.1, -0.1, 0.2]})
    good, bad = packages.write_json(tmp_path / "g.json", {"relative_periods": [0, 1, 2], "binary_actions": [1, 0, 1]}), packages.write_json(tmp_path / "b.json", {"relative_periods": [1, 1], "binary_actions": [2, 0]})
    assert run("evaluate-submission", good, truth)[0] == 0 and run("evaluate-submission", bad, truth)[0] == 2
    rows = packages.write_lines(tmp_path / "a.jsonl", [{"release_id": "r", "variant": "s1_basic"}])
    assert run("release-assess", rows)[0] == 5 and run("release-assess", packages.write_lines(tmp_path / "b.jsonl", [{"release_id": "r"}]))[0] == 3
    assert run("classroom-build", tmp_path / "s3b", tmp_path / "class")[0] == 0 and run("numeric-package", "abc")[0] == 0
