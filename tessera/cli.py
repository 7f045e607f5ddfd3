"""Command line: build and promote an index, match postings, decide on the matches."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.errors import TesseraError
from tessera.plans import build as bd
from tessera.plans import index, match
from tessera.sources.package import load_settings, markdown_table, write_json
from tessera.sources.store import at


def session() -> SparkSession:
    return SparkSession.builder.appName("tessera").config("spark.sql.session.timeZone", "UTC").getOrCreate()


#: Commands that build an index, and the last stage of each: what is done is kept, so each
#: goes on from the one before. An index's tables are its store, so nothing is uploaded.
STEPS = {
    "ingest": ("records", "make the canonical records of a concept package"),
    "validate": ("validate", "check the records and report on them"),
    "embed": ("lexical", "encode labels and documents"),
    "verify": ("verify", "check the index as a whole"),
    "build": ("verify", "build an index of a concept package, all stages"),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="command", required=True)
    for name, (until, what) in STEPS.items():
        b = sub.add_parser(name, help=what)
        b.add_argument("--source", required=True)
        b.add_argument("--work", required=True)
        b.add_argument("--config")
        b.set_defaults(until=until, promote=None)
        if until == "verify":
            b.add_argument("--promote", metavar="POINTER")
    m = sub.add_parser("match-jobs", help="match postings to the promoted index")
    for name in ("jobs", "categories", "work"):
        m.add_argument(f"--{name}", required=True)
    which = m.add_mutually_exclusive_group(required=True)
    which.add_argument("--pointer", help="names the promoted index")
    which.add_argument("--index-build", help="an index's folder, whatever is promoted")
    m.add_argument("--config")
    r = sub.add_parser("promote", help="point at a verified build")
    r.add_argument("--build-dir", required=True)
    r.add_argument("--pointer", required=True)
    d = sub.add_parser("decide", help="decisions of a match build, as JSON lines and a report")
    d.add_argument("--build-dir", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--threshold", type=float, default=match.DEFAULTS["threshold"])
    return p


def decide(spark: SparkSession, build_dir: str, out: str, threshold: float) -> dict:
    """Writes decisions and the unmapped ones as JSON, a summary and a Markdown report."""
    made = match.decisions(spark, bd.Build(at(build_dir), match.STAGES), threshold).persist()  # read by three sinks
    made.write.mode("overwrite").json(f"{out}/decisions")
    made.where("status = 'unmapped'").write.mode("overwrite").json(f"{out}/unmapped")
    counts = {r.status: r["count"] for r in made.groupBy("status").count().collect()}
    whole = made.agg(F.sum("n_matches").alias("pairs"), F.avg("n_matches").alias("mean")).first()
    summary = {"postings": sum(counts.values()), "threshold": threshold, **counts, "pairs": whole.pairs or 0}
    made.unpersist()
    write_json(at(out) / "summary.json", summary)
    (at(out) / "report.md").write_text(markdown_table(["figure", "value"], summary.items()))
    return summary


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        if args.command == "promote":
            bd.promote(bd.Build(at(args.build_dir), index.STAGES), args.pointer)
            return 0
        spark = session()
        if args.command in STEPS:
            made = index.build_index(spark, args.source, args.work, load_settings(args.config, index.DEFAULTS), args.until)
            if args.promote:
                bd.promote(made, args.promote)
            print(made.path)
        elif args.command == "match-jobs":
            made = match.match_postings(spark, args.jobs, args.categories, args.pointer, args.work, load_settings(args.config, match.DEFAULTS), args.index_build)
            print(made.path)
        else:
            print(decide(spark, args.build_dir, args.out, args.threshold))
    except TesseraError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
