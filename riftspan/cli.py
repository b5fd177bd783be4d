"""Command line: one subcommand per tool."""

from __future__ import annotations

import argparse
import logging
import shutil
import sys

from pyspark.sql import SparkSession

from riftspan import __version__, tools
from riftspan.config import load_config
from riftspan.errors import RiftspanError
from riftspan.plans.standardize import TOOLS
from riftspan.session import checkpoints_written, drop_checkpoints, mounted_folder
from riftspan.sources.regions import parse_regions


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="riftspan", description="Structural-variant evidence on Spark.")
    parser.add_argument("--version", action="version", version=__version__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, with_regions: bool = True, many: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text, description=text)
        sub.add_argument("-v", dest="verbosity", action="count", default=0, help="increase verbosity")
        sub.add_argument("--overwrite", action="store_true", help="allow overwriting of output")
        sub.add_argument("-c", "--config", metavar="FILE", help="TOML configuration file")
        sub.add_argument("--single-file", action="store_true", help="merge output parts into one local file")
        sub.add_argument("--compat", action="store_true", help="reproduce the original's quirks")
        if with_regions:
            sub.add_argument("-r", "--regions", metavar="REGIONS", help="comma-separated list of regions")
        sub.add_argument("input", nargs="+" if many else None, help="input file")
        sub.add_argument("output", help="output file or folder")
        return sub

    add("stage", "write a table sorted by position, for fast reading of regions", with_regions=False)
    add("scan", "select reads with evidence and their mates")
    add("unique", "remove repeated alignments and number templates", with_regions=False)
    add("collect-pesr", "extract paired-end and split-read evidence")
    add("collect-doc", "compute windowed depth of coverage")
    add("standardize", "bring variants of a caller into the common layout").add_argument(
        "-t", "--tool", required=True, choices=TOOLS, help="variant caller"
    )
    add("cluster", "cluster variants of several files", many=True).add_argument(
        "-s", "--setting", default="per_tool_pesr", help="clustering preset: per_tool_pesr or per_tool_doc"
    )
    sub = add("annotate", "annotate variants with evidence")
    for option in ("pesr-evidence", "doc-evidence", "snv-vcf", "out-doc-summary", "out-baf-snvs"):
        sub.add_argument(f"--path-{option}", metavar="FILE")
    sub.add_argument("-s", "--sample", required=True, help="sample to annotate")
    return parser


def _spooled(spark: SparkSession, path: str) -> str:
    """Standard input has no splits to read in parallel, so it is written to the shared folder first."""
    if path != "-":
        return path
    head = sys.stdin.buffer.peek(2)[:2]
    suffix = ".bam" if head == b"\x1f\x8b" else ".sam"
    name = mounted_folder(spark, "riftspan-stdin") + suffix
    with open(name, "wb") as target:
        shutil.copyfileobj(sys.stdin.buffer, target)
    return name


def run(spark: SparkSession, argv: list[str]) -> None:
    """Parse arguments and run the chosen tool; its intermediate tables are deleted at the end."""
    before = checkpoints_written()
    try:
        _run(spark, _parser().parse_args(argv))
    finally:
        drop_checkpoints(spark, before)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    logging.basicConfig(level=logging.DEBUG if args.verbosity else logging.INFO)
    config = load_config(args.config)
    common = {"config": config, "overwrite": args.overwrite, "single_file": args.single_file}
    listed = getattr(args, "regions", None)
    regions = parse_regions(listed, args.compat) if listed else None
    if args.command == "scan":
        tools.scan(spark, args.input, args.output, regions=regions, compat=args.compat, **common)
    elif args.command == "stage":
        tools.stage(spark, args.input, args.output, args.overwrite)
    elif args.command == "unique":
        tools.unique(spark, _spooled(spark, args.input), args.output, **common)
    elif args.command == "collect-pesr":
        tools.collect_evidence(spark, args.input, args.output, regions=regions, compat=args.compat, **common)
    elif args.command == "collect-doc":
        tools.collect_depth(spark, args.input, args.output, regions=regions, **common)
    elif args.command == "standardize":
        tools.standardize(spark, args.input, args.output, args.tool, regions=regions, compat=args.compat, **common)
    elif args.command == "cluster":
        tools.cluster(spark, args.input, args.output, args.setting, regions=regions, compat=args.compat, **common)
    else:
        tools.annotate(
            spark,
            args.input,
            args.output,
            args.sample,
            path_pesr_evidence=args.path_pesr_evidence,
            path_doc_evidence=args.path_doc_evidence,
            path_snv_vcf=args.path_snv_vcf,
            path_out_doc_summary=args.path_out_doc_summary,
            path_out_baf_snvs=args.path_out_baf_snvs,
            regions=regions,
            compat=args.compat,
            **common,
        )


def main() -> int:
    """Entry point; uses the session of ``spark-submit`` or a local one."""
    spark = SparkSession.builder.appName("riftspan").getOrCreate()
    try:
        run(spark, sys.argv[1:])
    except RiftspanError as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
