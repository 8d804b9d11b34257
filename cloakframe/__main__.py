"""Command line: python -m cloakframe COMMAND ...; `list` names the queries, `run` runs one, the others are jobs over files."""

from __future__ import annotations

import argparse
import hashlib
import json
import sys
from pathlib import Path

#: What the program returns.
OK, BAD_INPUT, PRIVACY, FAILED, INELIGIBLE = 0, 2, 3, 4, 5

#: Job: its arguments in order (those with a default are options), and what it does.
JOBS: dict[str, tuple[tuple[str, ...], str]] = {
    "registry-validate": (("registry",), "load report of a registry"), "registry-inventory": (("registry",), "values by kind"), "identities-compile": (("atlas",), "plan of an atlas"), "atlas-harvest": (("folder",), "candidates from texts"),
    "ingest": (("folder",), "files of an archive"), "extract": (("folder",), "sections of HTML files"), "campaign": (("config",), "companies of a configuration"), "mask": (("folder", "registry"), "masked texts"),
    "scan": (("folder", "registry"), "values left in a tree"), "discover": (("folder",), "what looks like an identifier"), "submission": (("folder",), "texts scrubbed for a submission"), "chunk": (("folder",), "chunks with their risk"),
    "structured-transform": (("prices", "variant"), "a price variant"), "s3-transform": (("prices", "variant"), "a variant that may be released"), "s3-attack": (("prices", "variant", "source"), "the suite of attacks"),
    "s3-assess": (("evidence", "variant", "policy"), "the decision on evidence"), "evaluate-submission": (("submission", "truth"), "metrics of a submission"), "attack-run": (("source", "masked"), "masked series against the source"),
    "utility-evaluate": (("source", "masked"), "what masked series keep"), "release-assess": (("assessments",), "decisions on releases"), "release-export": (("package", "target", "registry"), "a package as a zip file"),
    "classroom-build": (("features", "target"), "a package for a class"), "boundary-diag": (("private", "repository"), "whether a private folder lies outside"), "numeric-package": (("ticker",), "synthetic statements"),
    "reanonymize-run": (("folder", "registry", "work"), "extract, mask, scan, decide"), "pilot-run": (("prices", "variant", "source", "policy", "work"), "features, attacks, decision"),
}
_NAMES = {"submission": "submission", "structured-transform": "transform", "reanonymize-run": "reanonymise", "pilot-run": "pilot"}


def sha_of_file(path: str) -> str:
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cloakframe", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the queries")
    run = sub.add_parser("run", help="run a query over a folder of tables and write its rows")
    run.add_argument("name")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--format", default="parquet", choices=("parquet", "json", "csv", "orc"))
    for name, what in (("hash", "text"), ("hash-file", "path"), ("hash-json", "path")):
        sub.add_parser(name).add_argument(what)
    for name, (arguments, about) in JOBS.items():
        job = sub.add_parser(name, help=about)
        for a in arguments:
            job.add_argument(a)
        job.add_argument("--output", help="where rows are written; without it they are shown")
        job.add_argument("--format", default="parquet", choices=("parquet", "json", "csv", "orc"))
    return parser


def _hashed(args: argparse.Namespace) -> int:
    if args.command == "hash":
        print(hashlib.sha256(args.text.encode()).hexdigest())
        return OK
    if not Path(args.path).is_file():
        print(f"no such file: {args.path}", file=sys.stderr)
        return BAD_INPUT
    if args.command == "hash-file":
        print(sha_of_file(args.path))
    else:
        print(hashlib.sha256(json.dumps(json.loads(Path(args.path).read_text()), sort_keys=True, separators=(",", ":")).encode()).hexdigest())
    return OK


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from .plans import jobs, registry

    if args.command == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return OK
    if args.command.startswith("hash"):
        return _hashed(args)
    if args.command == "run" and args.name not in registry.QUERIES:
        print(f"no such query: {args.name}", file=sys.stderr)
        return BAD_INPUT
    from pyspark.sql import DataFrame, SparkSession

    from .sources.files import write_table

    spark = SparkSession.builder.appName(f"cloakframe {args.command}").getOrCreate()
    try:
        if args.command == "run":
            write_table(registry.QUERIES[args.name](spark, args.input), args.output, args.format)
            return OK
        job = getattr(jobs, _NAMES.get(args.command, args.command.replace("-", "_")))
        result, code = job(spark, *[getattr(args, a) for a in JOBS[args.command][0]])
        if isinstance(result, DataFrame) and args.output:
            write_table(result, args.output, args.format)
        elif isinstance(result, DataFrame):
            result.show(20, truncate=80)
        else:
            print(result if isinstance(result, str) else json.dumps(result, sort_keys=True, default=str))
        return code
    except FileNotFoundError as e:
        print(f"no such file: {e.filename}", file=sys.stderr)
        return BAD_INPUT
    except Exception as e:  # noqa: BLE001 - reported and turned into an exit code
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
