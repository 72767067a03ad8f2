"""Command line: run one of the three main flows on a file and print the result.

    python -m tessera rank      ARTICLE_FILE
    python -m tessera cluster   POSTING_FILE [--debug]
    python -m tessera timeusage SURVEY_CSV

Options go before the command: ``--input-bytes N`` sizes scan splits and
shuffle partitions for an input of about N bytes (see
``session.scale_settings``). The session comes from ``build_session()``;
submit with ``spark-submit`` to run on a cluster.
"""

from __future__ import annotations

import argparse

from .programs import cluster_posting_file, rank_article_file, time_usage_by_life_period
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m tessera")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("rank", help="rank languages by the articles mentioning them").add_argument("path")
    cluster = sub.add_parser("cluster", help="cluster questions and print the cluster report")
    cluster.add_argument("path")
    cluster.add_argument("--debug", action="store_true", help="print every k-means step")
    sub.add_parser("timeusage", help="average hours per working status, sex and age").add_argument("path")
    parser.add_argument(
        "--input-bytes", type=int, default=None, help="approximate input size; sizes scan splits and shuffles"
    )
    args = parser.parse_args(argv)

    spark = build_session(input_bytes=args.input_bytes, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    try:
        if args.command == "rank":
            rankings = rank_article_file(spark, args.path)
            for label, df in (("naive", rankings.naive), ("using index", rankings.using_index), ("reduce", rankings.reduce)):
                print(f"Ranking ({label}):", [(r.lang, r.n) for r in df.collect()])
        elif args.command == "cluster":
            result = cluster_posting_file(spark, args.path, debug=args.debug)
            print("median score, main term and its share, questions in the cluster")
            for row in result.report.collect():
                print(row.line)
        else:
            time_usage_by_life_period(spark, args.path).show()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
