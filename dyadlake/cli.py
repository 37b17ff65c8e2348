"""Command line: ``python -m dyadlake.cli leaderboard|leaks|diversity|query ...``; results are written as Parquet or shown."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import leaderboard, leakage
from .plans import registry
from .session import session
from .sources.tables import read_any, write_table


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dyadlake", description=__doc__)
    p.add_argument("--out", help="folder for the result; shown where left out")
    sub = p.add_subparsers(dest="command", required=True)
    board = sub.add_parser("leaderboard", help="medians and hit rates per method from a metrics table")
    board.add_argument("metrics")
    board.add_argument("--k", type=int, nargs="+", default=[1, 5, 40])
    board.add_argument("--hit", type=float, default=0.23)
    leaks = sub.add_parser("leaks", help="label pairs that a split shares with train")
    leaks.add_argument("index")
    leaks.add_argument("--split", default="test")
    leaks.add_argument("--labels", nargs=2, default=["uniprot_R", "uniprot_L"])
    wide = sub.add_parser("diversity", help="distinct labels per split")
    wide.add_argument("index")
    wide.add_argument("--labels", nargs=2, default=["cluster_id_R", "cluster_id_L"])
    one = sub.add_parser("query", help="a registered query over a folder of tables")
    one.add_argument("name", choices=sorted(registry.queries()))
    one.add_argument("folder")
    return p


def run(spark, args: argparse.Namespace) -> DataFrame:
    if args.command == "leaderboard":
        metrics = read_any(spark, args.metrics)
        metrics = metrics if "rank" in metrics.columns else leaderboard.ranked(metrics)
        return leaderboard.leaderboard(metrics, ["method"], "system", "DockQ", args.hit, tuple(args.k), "rank", "model_name")
    if args.command == "leaks":
        index = read_any(spark, args.index)
        return leakage.leak_report(index.where(F.col("split") == args.split), index.where("split = 'train'"), *args.labels)
    if args.command == "diversity":
        return leakage.diversity(read_any(spark, args.index), F.col("split"), list(args.labels))
    return registry.queries()[args.name](spark, args.folder)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    result = run(session(), args)
    if args.out:
        write_table(result, args.out)
    else:
        result.show(100, truncate=False)


if __name__ == "__main__":
    main()
