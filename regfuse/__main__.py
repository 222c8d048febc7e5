"""Command line: ``python -m regfuse INPUT_DIR [OUTPUT_DIR] [--format csv|parquet] [--locale auto|comma|dot]``.

The session comes from the environment (``spark-submit`` / cluster
defaults); only unset settings are filled in (see ``session.ensure_conf``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from regfuse.plans.pipeline import run
from regfuse.session import ensure_conf


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="regfuse", description="Fuse presented and recommended registers.")
    ap.add_argument("input_dir")
    ap.add_argument("output_dir", nargs="?", default=None, help="default: INPUT_DIR/processed")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--locale", default="auto", choices=["auto", "comma", "dot"])
    a = ap.parse_args(argv)
    spark = ensure_conf(SparkSession.builder.appName("regfuse").getOrCreate())
    run(spark, a.input_dir, a.output_dir, fmt=a.format, locale=a.locale)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
