"""Command line: build, migrate, search, verify, audit, evaluate."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import scorers
from ledgerlight.operators import audit, build, evaluate, search
from ledgerlight.sources import files
from ledgerlight.sources.rolls import REGISTRY, states_in_script


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerlight", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="publish the areas of a state that aren't published yet")
    b.add_argument("state", choices=sorted(REGISTRY))
    b.add_argument("raw")
    b.add_argument("out")
    b.add_argument("--areas", required=True, help="JSON list of the state's areas")
    b.add_argument("--year", type=int, default=2002)
    b.add_argument("--contract", default=build.CONTRACT)
    b.add_argument("--patch", type=int, default=build.PATCH)
    b.add_argument("--ac", nargs="*", help="only these areas")
    m = sub.add_parser("migrate", help="fill missing Latin names into the next patch")
    m.add_argument("out")
    m.add_argument("--patch", type=int, default=build.PATCH)
    s = sub.add_parser("search", help="best matches of a name")
    s.add_argument("table")
    s.add_argument("--name")
    s.add_argument("--relative")
    s.add_argument("--ac", nargs="*")
    s.add_argument("--part", type=int)
    s.add_argument("--gender", choices=["M", "F"])
    s.add_argument("--age", type=int)
    s.add_argument("--age-tolerance", type=int, default=search.AGE_TOLERANCE)
    s.add_argument("--algorithm", choices=list(scorers.ALGORITHMS), default=scorers.DEFAULT_ALGORITHM)
    s.add_argument("--min-score", type=float, default=search.MIN_SCORE)
    s.add_argument("--limit", type=int, default=search.LIMIT)
    v = sub.add_parser("verify", help="find one record again in a newer roll")
    v.add_argument("table")
    v.add_argument("id", type=int)
    v.add_argument("--ac", required=True)
    v.add_argument("--year", type=int, required=True, help="year of the newer roll")
    a = sub.add_parser("audit", help="anomalies of raw delimited files, as JSON")
    a.add_argument("raw")
    a.add_argument("--areas", required=True)
    sub.add_parser("evaluate", help="recall and rank of the scorers on the invented names")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """Lines that the command prints."""
    if args.command == "build":
        entry, areas = REGISTRY[args.state], files.constituencies(spark, args.areas)
        listed = files.raw_files(spark, args.raw, entry.glob).select(F.lit(args.state).alias("state"), files.area_of(F.col("file")).alias("ac_code"))
        if args.ac:
            unknown = set(args.ac) - {r.ac_code for r in areas.where(F.col("ac_code").isin(args.ac)).collect()}
            if unknown:
                raise SystemExit(f"Unknown areas: {', '.join(sorted(unknown))}")
            listed = listed.where(F.col("ac_code").isin(args.ac))
        done = build.publish(entry.source.read(spark, args.raw, areas, args.year), listed, args.out, args.contract, args.patch)
        return [f"{r.state}/{r.ac_code}" for r in done.orderBy("state", "ac_code").collect()] or ["Nothing to do."]
    if args.command == "migrate":
        return [f"{build.migrate(spark, args.out, states_in_script('devanagari'), patch=args.patch)} names filled"]
    if args.command == "search":
        hits = search.search(spark.read.parquet(args.table), args.name, args.relative, algorithm=args.algorithm, min_score=args.min_score, limit=args.limit, ac_codes=args.ac, part_no=args.part, gender=args.gender, age=args.age, age_tolerance=args.age_tolerance)
        return _printed(hits)
    if args.command == "verify":
        rows = spark.read.parquet(args.table)
        one = rows.where((F.col("id") == args.id) & (F.col("ac_code") == args.ac)).first()
        if one is None:
            raise SystemExit("No such record")
        found, note = search.verify_record(rows, search.Record(one.ac_code, one.full_name, one.full_relative_name, one.gender, one.age, one.roll_year), args.year)
        return [note] if note else _printed(found)
    if args.command == "audit":
        report = audit.audit(files.delimited_rows(files.raw_files(spark, args.raw, "*.csv")), files.constituencies(spark, args.areas))
        return [json.dumps(json.loads(report.select(F.to_json(F.struct("*")).alias("j")).first().j), indent=2)]
    cases = evaluate.dataset(spark).cache()
    lines = []
    for name in scorers.ALGORITHMS:
        r = evaluate.evaluate(cases, lambda q, c, n=name: scorers.pair_score(q, c, n)).first()
        lines.append(f"{name:14s} " + " ".join(f"recall@{k} {r[f'recall_at_{k}']:.3f}" for k in evaluate.AT) + f" mrr {r.mrr:.3f}")
    return lines


def _printed(hits: DataFrame) -> list[str]:
    return [r.line for r in search.report(hits).collect()] or ["No matches."]


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlight").getOrCreate()
    print(*run(spark, args), sep="\n")


if __name__ == "__main__":
    main()
