"""Command line: ``python -m tickweave <job> ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tickweave.plans import jobs
from tickweave.plans.views import load_spec, run_views
from tickweave.sinks.feather import write_feather
from tickweave.sinks.tables import CODECS, compact
from tickweave.sources.feather import read_feather


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickweave")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, ranges: bool = True) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        p.add_argument("-i", "--input", required=True)
        p.add_argument("-o", "--output", required=True)
        if ranges:
            p.add_argument("--sets")
            p.add_argument("--runs")
        return p

    p = job("etl", "tree of run files to one checkpoint per agent type")
    p.add_argument("--agent-types", required=True)
    p.add_argument("--mode", default="widen", choices=("checked", "strict", "widen"))
    p.add_argument("--suffix", action="store_true")
    p.add_argument("--skip-unreadable", action="store_true")
    p = job("views", "numbers behind the views of a JSON specification", ranges=False)
    p.add_argument("-c", "--config", required=True)
    p = job("sensitivity", "metric checkpoints and density grids")
    for name in ("--parameters", "--table", "--metric"):
        p.add_argument(name, required=True)
    p.add_argument("--stride", type=int, default=1)
    p.add_argument("--checkpoint", action="store_true")
    p.add_argument("--percentile", type=float, default=100.0)
    p.add_argument("--format", default="parquet", choices=("parquet", "feather"))
    p = job("convert", "SQLite databases to a tree of Parquet run files")
    p.add_argument("--force", action="store_true")
    job("inspect", "dataset report")
    p = job("from-feather", "Feather to Parquet", ranges=False)
    p.add_argument("--compression", default="snappy", choices=CODECS)
    job("to-feather", "Parquet to Feather", ranges=False)
    return top


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    if a.input.rstrip("/") == a.output.rstrip("/"):
        raise SystemExit("input and output must differ")
    spark = SparkSession.builder.appName(f"tickweave-{a.job}").getOrCreate()
    if a.job == "etl":
        paths = jobs.build_checkpoints(spark, a.input, a.output, a.agent_types, a.sets, a.runs, a.mode, a.suffix, a.skip_unreadable)
        print(json.dumps(paths))
        for agent in paths:
            print(json.dumps({"rejects": agent, **jobs.reject_totals(spark, a.output, agent)}))
            for r in jobs.skip_totals(spark, a.output, agent).orderBy("reason").toLocalIterator():
                print(json.dumps({"skipped": agent, **r.asDict()}))
    elif a.job == "views":
        for name, table in run_views(spark, load_spec(a.config), a.input).items():
            table.write.mode("overwrite").parquet(f"{a.output}/{name}.parquet")
    elif a.job == "sensitivity":
        grids = jobs.sensitivity_grids(
            spark, a.input, a.parameters, a.table, a.metric, a.output, a.sets, a.runs, a.stride, a.checkpoint, a.percentile, format=a.format
        )
        for metric, grid in grids.items():
            grid.write.mode("overwrite").parquet(f"{a.output}/{metric}/density_{metric}.parquet")
    elif a.job == "convert":
        jobs.convert_databases(spark, a.input, a.output, a.sets, a.runs, a.force).show()
    elif a.job == "inspect":
        for part, table in vars(jobs.inspect_tree(spark, a.input, a.sets, a.runs)).items():
            table.write.mode("overwrite").option("header", "true").csv(f"{a.output}/{part}")
    elif a.job == "from-feather":
        compact(read_feather(spark, a.input), a.output, compression=a.compression)
    else:
        write_feather(spark.read.parquet(a.input), a.output).show(truncate=False)


if __name__ == "__main__":
    main()
