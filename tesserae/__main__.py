"""python -m tesserae COMMAND

list | run NAME SF_DIR [OUT] | explain NAME SF_DIR | strategy TEXT
init ROOT
config ROOT list [KIND] | add KIND NAME [name=value ...] | update KIND NAME name=value ... | delete KIND NAME
projects ROOT list | add PROJECT SAMPLE [name=value ...] | update ... | delete PROJECT SAMPLE | merge PROJECT SAMPLE PROJECT/SAMPLE ...
longread align READS SIGNATURES OUT | report MATCHES SIGNATURES NAME OUT [--include TEXT] [--exclude TEXT]
"""

from __future__ import annotations

import argparse

import yaml
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tesserae import registry
from tesserae.operators import catalog, longread
from tesserae.operators.strategy import parse_strategy
from tesserae.project import Project, values_of
from tesserae.sources.sequences import read_any


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("tesserae", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    for c in ("run", "explain"):
        p = commands.add_parser(c)
        p.add_argument("name", choices=sorted(registry.queries()))
        p.add_argument("sf_dir")
        if c == "run":
            p.add_argument("out", nargs="?", help="folder for Parquet; without one the first rows are shown")
    commands.add_parser("strategy").add_argument("text")
    commands.add_parser("init").add_argument("root")
    p = commands.add_parser("config")
    p.add_argument("root")
    p.add_argument("action", choices=["list", "add", "update", "delete"])
    p.add_argument("kind", nargs="?")
    p.add_argument("name", nargs="?")
    p.add_argument("values", nargs="*")
    p = commands.add_parser("projects")
    p.add_argument("root")
    p.add_argument("action", choices=["list", "add", "update", "delete", "merge"])
    p.add_argument("project", nargs="?")
    p.add_argument("sample", nargs="?")
    p.add_argument("values", nargs="*")
    actions = commands.add_parser("longread").add_subparsers(dest="action", required=True)
    p = actions.add_parser("align")
    for a in ("reads", "signatures", "out"):
        p.add_argument(a)
    p = actions.add_parser("report")
    for a in ("matches", "signatures", "name", "out"):
        p.add_argument(a)
    p.add_argument("--include")
    p.add_argument("--exclude")
    return top


def config(args: argparse.Namespace) -> None:
    own = Project.open(args.root)
    if args.action == "list":
        kinds = own.config.kinds if args.kind is None else {args.kind: own.config.kinds[args.kind]}
        print(yaml.safe_dump(kinds, sort_keys=False), end="")
        return
    if args.action == "delete":
        own.config.delete(args.kind, args.name)
    else:
        (own.config.add if args.action == "add" else own.config.update)(args.kind, args.name, **values_of(args.values))
    own.save()


def projects(args: argparse.Namespace) -> None:
    own = Project.open(args.root)
    if args.action == "list":
        for (p, s), r in own.catalog.samples.items():
            print(p, s, r.get("species") or "", ",".join(r["run_modes"]), sep="\t")
        return
    if args.action == "delete":
        own.catalog.delete(args.project, args.sample)
    elif args.action == "merge":
        own.catalog.merge(args.project, args.sample, [tuple(v.split("/", 1)) for v in args.values])
    else:
        (own.catalog.add if args.action == "add" else own.catalog.update)(args.project, args.sample, **values_of(args.values))
    own.save()


def long_reads(spark: SparkSession, args: argparse.Namespace) -> None:
    """align: the matches of all blocks in the reads; report: counts of signatures, their completeness and part histograms."""
    text = "\n".join(r[0] for r in spark.read.text(args.signatures, wholetext=True).collect())
    blocks, signatures = catalog.signature_catalog(text)
    if args.action == "align":
        reads = read_any(spark, args.reads).select(F.col("name").alias("qname"), "seq")
        longread.oligo_matches(reads, blocks).write.mode("overwrite").parquet(args.out)
        return
    own = signatures[args.name]
    intact = own["intact_bead"].split(",")
    rows = longread.oriented(longread.per_read(longread.relevant_matches(spark.read.parquet(args.matches), blocks)), own.get("read1_primer") or intact[0])
    rows = longread.with_signatures(rows, args.include, args.exclude)
    for name, df in (("signatures", longread.signature_counts(rows)), ("completeness", longread.completeness(rows, intact)), ("parts", longread.part_histograms(rows))):
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.command == "list":
        print(*sorted(registry.queries()), sep="\n")
    elif args.command == "strategy":
        rules, links = parse_strategy(args.text)
        print(*[f"{r.source} -> {r.output}" for r in rules], *[f"{k} = {v}" for k, v in links.items()], sep="\n")
    elif args.command == "init":
        print(Project.init(args.root).path)
    elif args.command in ("config", "projects"):
        (config if args.command == "config" else projects)(args)
    else:
        spark = SparkSession.builder.appName("tesserae").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if args.command == "longread":
            long_reads(spark, args)
            return
        df = registry.queries()[args.name](spark, args.sf_dir)
        if args.command == "explain":
            df.explain("formatted")
        elif args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(20, truncate=False)


if __name__ == "__main__":
    main()
