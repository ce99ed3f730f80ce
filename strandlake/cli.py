"""Command line: process, extract-cpgs, qc-report, download-genome."""

from __future__ import annotations

import argparse
import json
import logging


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strandlake", description=__doc__)
    parser.add_argument("-v", "--verbose", action="store_true")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("process", help="coverage files to assays and reports")
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--genome", required=True, help="FASTA file, site file or site folder")
    p.add_argument("--threads", type=int, default=8)
    p.add_argument("--min-coverage", type=int, default=1)
    p.add_argument("--remove-uncovered", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--annotation-dir")
    p.add_argument("--skip-annotation", action="store_true")
    p.add_argument("--table-parts", action="store_true", help="write the annotation table as a folder of parts")
    p = sub.add_parser("extract-cpgs", help="FASTA to sites")
    p.add_argument("--fasta", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--contigs", nargs="*")
    p = sub.add_parser("qc-report", help="coverage report of a store")
    p.add_argument("--store", required=True)
    p.add_argument("--output", required=True)
    p = sub.add_parser("download-genome", help="a pinned genome")
    p.add_argument("--name", required=True)
    p.add_argument("--manifest", help="JSON list of name, url, md5; the releases known here by default")
    p.add_argument("--output-dir", required=True)
    return parser


def session(threads: int):
    """A session under the master that the launcher gives; local without one."""
    from pyspark import SparkConf, SparkContext
    from pyspark.sql import SparkSession

    SparkContext._ensure_initialized()
    builder = SparkSession.builder.appName("strandlake")
    if not SparkConf().contains("spark.master"):
        builder = builder.master(f"local[{max(1, threads)}]")
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    if args.command == "download-genome":
        from .sources.download import RELEASES, Release, download_genome, find_release

        manifest = list(RELEASES)
        if args.manifest:
            with open(args.manifest, encoding="utf-8") as f:
                manifest = [Release(**x) for x in json.load(f)]
        print(download_genome(args.output_dir, find_release(manifest, args.name)))
        return 0
    from .plans import pipeline

    spark = session(getattr(args, "threads", 8))
    if args.command == "process":
        pipeline.process(spark, pipeline.Config(args.input_dir, args.output_dir, args.genome, args.threads, args.min_coverage, args.remove_uncovered, args.annotation_dir, args.skip_annotation, args.table_parts))
    elif args.command == "extract-cpgs":
        pipeline.extract_cpgs(spark, args.fasta, args.output, args.contigs)
    else:
        pipeline.qc_report(spark, args.store, args.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
