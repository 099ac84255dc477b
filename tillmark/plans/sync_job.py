"""Keep Parquet copies of a database in step.

    spark-submit -m tillmark.plans.sync_job --url jdbc:... --base hdfs://... [--full | --hook]

Without a mode only rows newer than the last run are exported. ``--full`` and ``--hook``
export every table anew.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from tillmark.session import build_session
from tillmark.sources.sync import Exported, sync_all
from tillmark.sources.tables import Jdbc


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Export database tables to Parquet.")
    parser.add_argument("--url", required=True, help="JDBC URL of the database")
    parser.add_argument("--base", required=True, help="folder the copies are kept in")
    parser.add_argument("--user", default="")
    parser.add_argument("--password-file", help="file holding the password")
    parser.add_argument("--driver", default="com.mysql.cj.jdbc.Driver")
    parser.add_argument("--database", default="retail", help="database to list tables of")
    parser.add_argument("--tables", nargs="*", help="tables to export; all by default")
    parser.add_argument("--parts", type=int, default=200, help="parallel queries per table")
    parser.add_argument("--overlap-minutes", type=int, default=0,
                        help="reach back this far behind the mark for late rows")
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("--full", action="store_true")
    mode.add_argument("--hook", action="store_true")
    return parser.parse_args(argv)


def run(args: argparse.Namespace) -> list[Exported]:
    spark = build_session("retail-sync")
    properties = {"user": args.user, "driver": args.driver}
    if args.password_file:
        with open(args.password_file) as f:
            properties["password"] = f.read().strip()
    database = Jdbc(args.url, properties)
    overlap = dt.timedelta(minutes=args.overlap_minutes) if args.overlap_minutes else None
    names = args.tables
    if not names:
        names = sorted(r.table_name for r in database.tables(spark, args.database).collect())
    def source(table: str):
        return database.read(spark, table)

    def split(table: str) -> str | None:
        """The column range queries go by, where the table has it."""
        return "id" if "id" in source(table).columns else None

    return sync_all(
        spark,
        source,
        args.base.rstrip("/"),
        names,
        incremental=not (args.full or args.hook),
        overlap=overlap,
        newer=lambda table, column, mark: database.read_after(
            spark, table, column, mark, split_by=split(table), parts=args.parts
        ),
        whole=lambda table: database.read(spark, table, split(table), args.parts),
    )


def main(argv: Sequence[str] | None = None) -> None:
    for done in run(arguments(argv)):
        print(f"{done.table}: {done.mode}, {done.rows} rows, mark {done.mark.mark}")


if __name__ == "__main__":
    main()
