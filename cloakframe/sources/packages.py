"""Release packages: what goes in, inventories, checksums, dossiers, zip files, manifests and checkpoints of stages.

A package is a folder of a release's size, so it is put together on the driver; what is in it comes from DataFrames."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The files of a dossier, and what its JSON may not name.
DOSSIER = ("README.md", "manifest.json", "privacy_report.json", "utility_report.json", "attack_summary.json", "transformation_summary.json", "release_decision.json", "checksums.json")
PRIVATE_MARKS = ("SRC_001", "private_root")
#: What is not packed.
LEFT_OUT = ("originals/", "private_maps/", "smoke_excerpts/", "exports/")
LEFT_OUT_ENDINGS = (".pyc", ".pyo", ".DS_Store")


def digest(data: bytes | str) -> str:
    """H01."""
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def file_digest(path: str | Path) -> str:
    """H01."""
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def canonical(value: object) -> str:
    """JSON with sorted keys and without blanks."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def write_bytes(path: str | Path, data: bytes) -> Path:
    """Written to a file beside it, synced, and renamed: a reader sees the old file or the whole new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f"{path.name}.", suffix=".tmp")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise
    return path


def write_json(path: str | Path, value: object) -> Path:
    """Keys sorted, indented."""
    return write_bytes(path, (json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False, default=str) + "\n").encode())


def write_lines(path: str | Path, rows: Iterable[object]) -> Path:
    """A JSON object a line."""
    return write_bytes(path, "".join(canonical(r) + "\n" for r in rows).encode())


def write_features(df: DataFrame, path: str, period: str, forbidden: Sequence[str] = (), kind: str = "csv") -> None:
    """Features in a fixed order of columns (period, then by name) and rows, as one file; columns or states that hold a
    forbidden part are an error, before anything is written."""
    columns = [period, *sorted(c for c in df.columns if c != period)]
    bad = [c for c in columns for f in forbidden if f.lower() in c.lower()]
    strings = [c for c, t in df.dtypes if t == "string"]
    if forbidden and strings:
        parts = F.array(*[F.lit(f.lower()) for f in forbidden])

        def held(c: str) -> Column:
            return F.max(F.exists(parts, lambda v: F.contains(F.lower(F.col(f"`{c}`")), v))).alias(c)

        found = df.agg(*[held(c) for c in strings]).first()
        bad += [c for c in strings if found[c]]
    if bad:
        raise ValueError(f"forbidden parts in {sorted(set(bad))}")
    # a release's features are a few rows a week: one file
    df.select(*columns).orderBy(period).coalesce(1).write.mode("overwrite").option("header", True).format(kind).save(path)


def write_sidecar(path: str | Path) -> Path:
    """`<sha>  <name>` in a file beside it."""
    path = Path(path)
    return write_bytes(path.with_name(path.name + ".sha256"), f"{file_digest(path)}  {path.name}\n".encode())


def valid_sidecar(path: str | Path) -> bool:
    """Whether a file is the one that its sidecar names; without a sidecar, or with a malformed one, an error."""
    path = Path(path)
    parts = path.with_name(path.name + ".sha256").read_text().split()
    if len(parts) != 2 or len(parts[0]) != 64:
        raise ValueError(f"malformed sidecar of {path}")
    return parts[0] == file_digest(path)


def is_public(relative: str) -> bool:
    """Whether a path of a package is packed."""
    return not (relative.startswith(LEFT_OUT) or "__pycache__" in relative or relative.endswith(LEFT_OUT_ENDINGS))


def public_files(root: str | Path) -> list[str]:
    """The paths of a package that are packed, sorted."""
    root = Path(root)
    found = (p.relative_to(root).as_posix() for p in root.rglob("*") if p.is_file())
    return sorted(p for p in found if is_public(p))


def package_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, sha256) of the public files of a package, read by the executors."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = F.regexp_replace("path", r"^.*?" + "\\Q" + root.rstrip("/").split("://")[-1] + "/\\E", "")
    kept = rows.select(path.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    out = kept.filter(~F.col("path").rlike("__pycache__"))
    for head in LEFT_OUT:
        out = out.filter(~F.startswith("path", F.lit(head)))
    for tail in LEFT_OUT_ENDINGS:
        out = out.filter(~F.endswith("path", F.lit(tail)))
    return out


def write_checksums(root: str | Path, name: str = "checksums.sha256") -> Path:
    """`<sha>  <path>` of every public file but this one."""
    root = Path(root)
    lines = [f"{file_digest(root / p)}  {p}\n" for p in public_files(root) if p != name]
    return write_bytes(root / name, "".join(lines).encode())


def semantic_hash(root: str | Path, without: Sequence[str] = ("checksums.sha256",)) -> str:
    """Over the paths and bytes of a package's public files but some."""
    root, h = Path(root), hashlib.sha256()
    for p in public_files(root):
        if p not in without:
            h.update(p.encode() + b"\0" + bytes.fromhex(file_digest(root / p)))
    return h.hexdigest()


def write_zip(root: str | Path, target: str | Path, names: Mapping[str, str] | None = None, leaks: Callable[[str, str], bool] | None = None) -> Path:
    """The public files of a package as a zip file, under other names where `names` has them (longest first).

    It is written beside the target, read again, and only renamed if no member's name or text leaks."""
    root, target = Path(root), Path(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    staged = target.with_name(target.name + ".staged")
    pairs = sorted((names or {}).items(), key=lambda kv: -len(kv[0]))
    try:
        with zipfile.ZipFile(staged, "w", zipfile.ZIP_DEFLATED) as z:
            for p in public_files(root):
                if (root / p) in (target, staged):
                    continue
                out = p
                for a, b in pairs:
                    out = out.replace(a, b)
                info = zipfile.ZipInfo(out, (1980, 1, 1, 0, 0, 0))  # the same bytes in every run
                info.compress_type = zipfile.ZIP_DEFLATED
                z.writestr(info, (root / p).read_bytes())
        found = zip_faults(staged, leaks) if leaks else []
        if found:
            raise ValueError(f"leaks in {found}")
        os.replace(staged, target)
    finally:
        staged.unlink(missing_ok=True)
    return target


def zip_faults(path: str | Path, leaks: Callable[[str, str], bool]) -> list[str]:
    """The members of a zip file whose name or text leaks; texts are .md, .json, .csv, .txt and .sha256."""
    out = []
    with zipfile.ZipFile(path) as z:
        for name in z.namelist():
            text = z.read(name).decode("utf-8", "replace") if name.lower().endswith((".md", ".json", ".csv", ".txt", ".sha256")) else ""
            if leaks(name, text):
                out.append(name)
    return out


def leaking(values: Sequence[str], least: int = 3) -> Callable[[str, str], bool]:
    """A test for names that hold a value in any case, or texts that hold it by case."""
    held = [v for v in values if len(v) >= least]
    return lambda name, text: any(v.lower() in name.lower() or v in text for v in held)


def write_dossier(root: str | Path, company: str, release: str, policy: str, reports: Mapping[str, object], limitations: Sequence[str] = (), variant: str = "") -> list[str]:
    """The eight files of a dossier; `reports` has the six JSON reports by name. A variant that may not be released is an
    error. Returns the faults of what was written."""
    from ..operators.gates import assert_releasable

    if variant:
        assert_releasable(variant)
    root = Path(root)
    listed = [f"- `{n}`" for n in DOSSIER if n != "README.md"]
    more = ["", "## Limitations", "", *[f"- {x}" for x in limitations]] if limitations else []
    readme = "\n".join([f"# {company} Synthetic Data Release", "", f"**Release:** {release}", f"**Policy:** {policy}", "", "## Contents", "", *listed, "", "## Disclaimers", "", "- Prices are not historical prices.", "- Re-identification by further analysis cannot be ruled out.", *more, ""])
    write_bytes(root / "README.md", readme.encode())
    for name in DOSSIER[1:-1]:
        write_json(root / name, reports.get(name.removesuffix(".json"), {}))
    write_json(root / "checksums.json", {n: file_digest(root / n) for n in DOSSIER[:-1]})
    return dossier_faults(root)


def dossier_faults(root: str | Path, required: Sequence[str] = DOSSIER, marks: Sequence[str] = PRIVATE_MARKS) -> list[str]:
    """Files that lack, JSON that names what is private, and files that their checksum does not fit."""
    root = Path(root)
    out = [f"missing {n}" for n in required if not (root / n).is_file()]
    for p in sorted(root.rglob("*.json")):
        text = p.read_text(errors="replace")
        out += [f"{m} in {p.relative_to(root)}" for m in marks if m in text]
    if (root / "checksums.json").is_file():
        out += [f"checksum of {n}" for n, sha in json.loads((root / "checksums.json").read_text()).items() if (root / n).is_file() and file_digest(root / n) != sha]
    return out


def write_classroom(root: str | Path, features: DataFrame, summary: Mapping[str, object], weeks: int) -> Path:
    """A package for a class: features, a privacy summary, a template of a submission, an example that alternates, and
    checksums."""
    root = Path(root)
    rows = [json.loads(r) for r in features.orderBy(features.columns[0]).toJSON().collect()]  # a few hundred weeks
    write_json(root / "features.json", rows)
    write_json(root / "privacy_summary.json", summary)
    write_json(root / "submission_template.json", {"relative_periods": [], "binary_actions": []})
    write_json(root / "example_submission.json", {"relative_periods": list(range(weeks)), "binary_actions": [i % 2 for i in range(weeks)]})
    return write_checksums(root)


def manifest(artifact: str, source: str, path: str, size: int, sha256: str, run: str, ticker: str, **more: object) -> dict[str, object]:
    """The manifest of an artefact, with the ticker replaced by the company's pseudonym in its id and path."""
    company = f"COMP_{digest(ticker.upper())[:12]}"
    return {"artifact_id": artifact.replace(ticker, company), "company_id": company, "source": source, "relative_output_path": path.replace(ticker, company), "byte_size": size, "sha256": sha256, "run_id": run, "schema_version": "1.0.0", **more}


def run_manifest(run: str, company: str, parts: Mapping[str, Sequence[Mapping[str, object]]]) -> dict[str, object]:
    """The manifests of a run with a hash that does not depend on the run or its times."""
    body = {"run_id": run, "company_pseudonym": company, "schema_version": "1.0.0", **{k: list(v) for k, v in parts.items()}}
    return {**body, "semantic_hash": manifest_hash(body)}


def manifest_hash(value: object) -> str:
    """A hash of a manifest without run ids and times, at any depth."""

    def clean(x: object) -> object:
        if isinstance(x, Mapping):
            return {k: clean(v) for k, v in x.items() if k not in ("fetch_timestamp", "generated_at", "run_id", "semantic_hash")}
        return [clean(v) for v in x] if isinstance(x, list | tuple) else x

    return digest(canonical(clean(value)))


def save_checkpoint(base: str | Path, company: str, stage: str, inputs: str, config: str, version: str, artifacts: Sequence[str | Path], status: str = "completed") -> Path:
    """What a stage read, its settings and the hashes of what it wrote."""
    held = [{"path": str(a), "hash": file_digest(a)} for a in artifacts]
    return write_json(Path(base) / ".checkpoints" / company / f"{stage}.json", {"stage": stage, "company_id": company, "input_hash": inputs, "config_hash": config, "pipeline_version": version, "status": status, "output_artifacts": held})


def checkpoint_state(base: str | Path, company: str, stage: str, inputs: str, config: str, version: str) -> str:
    """`valid`, or why a stage must run again: none, not_completed, version_changed, input_changed, config_changed,
    missing_artifact, artifact_changed. A checkpoint that cannot be read is an error."""
    path = Path(base) / ".checkpoints" / company / f"{stage}.json"
    if not path.is_file():
        return "none"
    try:
        held = json.loads(path.read_text())
    except ValueError as e:
        raise ValueError(f"corrupt checkpoint {path}") from e
    for name, wrong in (("not_completed", held["status"] != "completed"), ("version_changed", held["pipeline_version"] != version), ("input_changed", held["input_hash"] != inputs), ("config_changed", held["config_hash"] != config)):
        if wrong:
            return name
    for a in held["output_artifacts"]:
        if not Path(a["path"]).is_file():
            return "missing_artifact"
        if file_digest(a["path"]) != a["hash"]:
            return "artifact_changed"
    return "valid"


def resumed(base: str | Path, company: str, stages: Sequence[tuple[str, Callable[[], Sequence[str | Path]]]], inputs: str, config: str, version: str) -> list[str]:
    """Runs the stages in order, but those whose checkpoint is valid; a stage's input is the hash of the one before. Returns
    the names of the stages that ran."""
    ran = []
    for name, stage in stages:
        if checkpoint_state(base, company, name, inputs, config, version) != "valid":
            save_checkpoint(base, company, name, inputs, config, version, stage())
            ran.append(name)
        held = json.loads((Path(base) / ".checkpoints" / company / f"{name}.json").read_text())
        inputs = digest(canonical(held["output_artifacts"]))
    return ran


def decision_or_fail(path: str | Path) -> dict[str, object]:
    """The decision in a file; a file that lacks or cannot be read is written as a failure."""
    path = Path(path)
    try:
        found = json.loads(path.read_text())
        if isinstance(found, dict) and found.get("decision"):
            return found
    except (OSError, ValueError):
        pass
    write_json(path, {"decision": "FAIL", "reason": "no decision was written"})
    return {"decision": "FAIL", "reason": "no decision was written"}


def evidence_hash(path: str | Path) -> str:
    """A file's hash, or `placeholder`, which no gate accepts."""
    return file_digest(path) if Path(path).is_file() else "placeholder"


def private_root(path: str | Path, repository: str | Path) -> Path:
    """P20: a private folder, made if it lacks; one within the repository, or that is no folder, is an error."""
    root, repo = Path(path).expanduser().resolve(), Path(repository).resolve()
    if root == repo or repo in root.parents:
        raise ValueError("the private folder lies within the repository")
    if root.exists() and not root.is_dir():
        raise ValueError("the private folder is no folder")
    root.mkdir(parents=True, exist_ok=True)
    return root


def under(root: str | Path, path: str | Path) -> Path:
    """P20: a path under a folder; one that leads out of it is an error."""
    whole = (Path(root) / path).resolve()
    if Path(root).resolve() not in (whole, *whole.parents):
        raise ValueError("the path leads out of its folder")
    return whole


def load_companies(path: str | Path) -> dict[str, dict[str, object]]:
    """Companies of a YAML file (companies: {id: {...}}), each with a source_identity; the file's values may name settings of
    the environment as ${NAME}, and one that is not set is an error."""
    import re

    import yaml

    def known(m: re.Match) -> str:
        if m.group(1) not in os.environ:
            raise ValueError(f"{m.group(1)} is not set")
        return os.environ[m.group(1)]

    found = yaml.safe_load(re.sub(r"\$\{(\w+)\}", known, Path(path).read_text()))
    companies = found.get("companies") if isinstance(found, Mapping) else None
    if not isinstance(companies, Mapping):
        raise ValueError("no companies")
    lacking = [k for k, v in companies.items() if not isinstance(v, Mapping) or not v.get("source_identity")]
    if lacking:
        raise ValueError(f"companies without a source identity: {lacking}")
    return {str(k): dict(v) for k, v in companies.items()}
