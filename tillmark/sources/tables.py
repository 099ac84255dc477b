"""Reading and writing retail tables as Parquet or through JDBC."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]


# --- Parquet ---------------------------------------------------------------------------


def read_table(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base.rstrip('/')}/{table}")


def after_mark(df: DataFrame, column: str, mark: str | dt.datetime | dt.date) -> DataFrame:
    """Rows strictly later than the mark.

    The mark becomes a literal of the column's own type, so the test reaches the scan.
    """
    return df.where(F.col(column) > F.lit(str(mark)).cast(df.schema[column].dataType))


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("high_water_mark"))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_by_time(df: DataFrame, path: str, column: str, key: str = "id") -> None:
    """Replace a table with its rows in time order.

    Each file then covers a short span, so a query over the last days skips the other
    files by their statistics. Rows of the same time are spread by their key.
    """
    order = [F.col(column), F.xxhash64(key)]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """The tables of a database, views left out."""
    found = spark.catalog.listTables(database)
    return sorted(t.name for t in found if t.tableType not in ("VIEW", "TEMPORARY"))


# --- JDBC ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Jdbc:
    """A database reached through JDBC.

    MySQL reports ``tinyint(1)`` as a bit unless told otherwise, which would fold status
    codes 0 to 5 into true and false; the URL always switches that off.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        url = self.url
        if url.startswith("jdbc:mysql:") and "tinyInt1isBit" not in url:
            url += ("&" if "?" in url else "?") + "tinyInt1isBit=false"
        return {"url": url, **self.properties}

    def read(
        self,
        spark: SparkSession,
        table: str,
        split_by: str | None = None,
        parts: int = 200,
        fetch_rows: int = 10_000,
    ) -> DataFrame:
        """A full scan. With ``split_by`` it runs as ``parts`` range queries on that column.

        The ranges hold about equally many rows each, whatever gaps the ids have: the database
        counts rows per range of ids, and more finely where many are.
        """
        return self._scan(spark, table, split_by, parts, fetch_rows)

    def _scan(
        self, spark: SparkSession, table: str, split_by: str | None, parts: int, fetch_rows: int,
        where: str | None = None,
    ) -> DataFrame:
        options = self.options()
        url = options.pop("url")
        properties = {**options, "fetchsize": str(fetch_rows)}
        ranges = [] if split_by is None else self._ranges(spark, table, split_by, parts, where)
        if not ranges:
            scan = spark.read.format("jdbc").options(url=url, **properties, dbtable=table)
            return scan.load() if where is None else scan.load().where(where)
        tests = [f"({r}) AND {where}" for r in ranges] if where else ranges
        return spark.read.jdbc(url, table, predicates=tests, properties=properties)

    def _ranges(
        self, spark: SparkSession, table: str, split_by: str, parts: int, where: str | None
    ) -> list[str]:
        def ask(query: str) -> list:
            return spark.read.format("jdbc").options(**self.options(), query=query).load().collect()

        test = f" WHERE {where}" if where else ""
        # As a query of its own the database answers it from the key.
        low, high = ask(f"SELECT MIN({split_by}) AS low, MAX({split_by}) AS high FROM {table}{test}")[0]
        if low is None:
            return []

        def count(ranges: list[tuple[int, int]], width: int) -> dict[int, int]:
            rows = ask(count_query(table, split_by, ranges, width, where))
            return {int(start): int(n) for start, n in rows}

        return range_predicates(split_by, balanced_cuts(count, int(low), int(high), parts))

    def read_after(
        self,
        spark: SparkSession,
        table: str,
        column: str,
        mark: str,
        split_by: str | None = None,
        parts: int = 200,
    ) -> DataFrame:
        """Rows later than the mark, selected by the database: Spark hands the test over.

        The range queries divide the ids of those rows only, not of the whole table.
        """
        if split_by is None:
            return after_mark(self.read(spark, table), column, mark)
        quoted = mark.replace("'", "''")
        return self._scan(spark, table, split_by, parts, 10_000, f"{column} > '{quoted}'")

    def tables(self, spark: SparkSession, database: str) -> DataFrame:
        return (
            spark.read.format("jdbc")
            .options(**self.options(), dbtable="information_schema.tables")
            .load()
            .where((F.col("table_schema") == database) & (F.col("table_type") == "BASE TABLE"))
            .select(F.col("table_name").alias("table_name"))
        )

    def append(self, df: DataFrame, table: str, batch_rows: int = 1000, writers: int = 16) -> None:
        """Insert in batches, over a number of connections the database can bear."""
        self._write(df, table, "append", batch_rows, writers)

    def replace(self, df: DataFrame, table: str, batch_rows: int = 1000, writers: int = 16) -> None:
        """Empty the table and load it; its definition and indexes stay."""
        self._write(df, table, "overwrite", batch_rows, writers, truncate="true")

    def _write(
        self, df: DataFrame, table: str, mode: str, batch_rows: int, writers: int, **more: str
    ) -> None:
        sizes = {"batchsize": str(batch_rows), "numPartitions": str(writers)}
        (
            df.write.format("jdbc")
            .mode(mode)
            .options(**self.options(), dbtable=table, **sizes, **more)
            .save()
        )


def split_options(column: str, low, high, parts: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def count_query(
    table: str, column: str, ranges: list[tuple[int, int]], width: int, where: str | None = None
) -> str:
    """SQL for the rows per stretch of ``width`` ids, counted from the beginning of each range."""
    parts = []
    for low, high in ranges:
        test = f"{column} BETWEEN {low} AND {high}" + (f" AND {where}" if where else "")
        start = f"{column} - MOD({column} - {low}, {width})" if low >= 0 else f"{column} - MOD({column} + {-low}, {width})"
        parts.append(f"SELECT {start} AS start_id FROM {table} WHERE {test}")
    return f"SELECT start_id, COUNT(*) AS n FROM ({' UNION ALL '.join(parts)}) ids GROUP BY start_id"


def balanced_cuts(count, low: int, high: int, parts: int, stretches: int = 1024) -> list[int]:
    """Ids at which a new one of ``parts`` ranges begins, so that all hold about equally many rows.

    ``count(ranges, width)`` gives the rows per stretch of ``width`` ids, by its first id. Stretches
    with more than a quarter of a range's rows are counted again in finer ones, all together, so
    a few questions do, however the ids are spread.
    """
    done: dict[int, int] = {}
    open_, total = [(low, high)], None
    while open_:
        span = max(b - a + 1 for a, b in open_)
        width = max(1, -(-span // stretches))
        found = count(open_, width)
        if total is None:
            total = sum(found.values())
        begins = [a for a, _ in open_]
        ends = {s: min(s + width - 1, open_[bisect_right(begins, s) - 1][1]) for s in found}
        many = [s for s, n in found.items() if 4 * parts * n > total and ends[s] > s and width > 1]
        done |= {s: n for s, n in found.items() if s not in set(many)}
        open_ = sorted((s, ends[s]) for s in many)
    cuts, held = [], 0
    for start in sorted(done):
        # A range ends where it has its share; what a dense stretch has beyond that is no debt.
        if held * parts >= total and len(cuts) < parts - 1:
            cuts.append(start)
            held = 0
        held += done[start]
    return cuts


def range_predicates(column: str, cuts: list[int]) -> list[str]:
    """Tests that send every row to one range query; rows without an id go with the first."""
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def time_column(columns: list[str]) -> str | None:
    """The column an incremental export follows: update time, else creation time."""
    for name in ("update_time", "create_time"):
        if name in columns:
            return name
    return None
