"""Table sinks and scans. A load writes aside and is made current in one step of the catalogue; nothing is overwritten in place."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Tables are wide text for the most part, which takes far less disk this way than under the default codec.
CODEC = "zstd"


class Written(NamedTuple):
    """A written table and what was counted on the way."""

    table: DataFrame
    counts: dict[str, object]


def describe(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are kept in the schema that is written."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def counting(df: DataFrame, counts: Mapping[str, Column] | None, write: Callable[[DataFrame], DataFrame]) -> Written:
    """`write` the frame and take the aggregates `counts` of its rows in the same pass.

    They are taken by the tasks that write, each of which Spark counts once however often it is run again. A plan that turns
    out empty may lose them; they are then taken from the empty table.
    """
    if not counts:
        return Written(write(df), {})
    seen = Observation()
    aggregates = [c.alias(n) for n, c in counts.items()]
    table = write(df.observe(seen, *aggregates))
    return Written(table, seen.get or table.agg(*aggregates).first().asDict())


def publish(df: DataFrame, path: str, counts: Mapping[str, Column] | None = None) -> DataFrame | Written:
    """Write a table to the new folder `path` and go on from what was written, whose size the planner then knows.

    With `counts`, what was counted while writing comes along.
    """

    def write(rows: DataFrame) -> DataFrame:
        rows.write.option("compression", CODEC).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    written = counting(df, counts, write)
    return written if counts else written.table


def together(makers: Mapping[str, Callable[[], object]], at_once: int = 4) -> dict[str, object]:
    """Run jobs that do not need each other, a few at a time, so that one's last tasks overlap another's first."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(makers, pool.map(lambda make: make(), makers.values()), strict=True))


def publish_all(makers: Mapping[str, Callable[[], DataFrame]], folder: str, at_once: int = 4) -> dict[str, DataFrame]:
    """Publish tables that do not need each other, a few at a time."""
    return together({n: lambda n=n, make=make: publish(make(), f"{folder}/{n}") for n, make in makers.items()}, at_once)


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def expose(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Name frames for SQL in this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class Release:
    """A load under way: tables in a catalogue schema of its own, which readers of `name` do not see until `commit`.

    `name` is a view that names the schema of the current load. Replacing it is one change of one catalogue entry, so readers find
    either all tables of the load before or all of this one, whatever fails in between and whatever columns have changed.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str) -> None:
        self.spark, self.name = spark, name
        self.schema = f"{name}_{uuid.uuid4().hex}"
        place = _text(f"{folder.rstrip('/')}/{self.schema}")
        spark.sql(f"CREATE SCHEMA {self.schema} COMMENT {_text(f'load of {name}')} LOCATION {place}")

    def write(
        self,
        table: str,
        df: DataFrame,
        comment: str | None = None,
        comments: Mapping[str, str] | None = None,
        counts: Mapping[str, Column] | None = None,
        parts: tuple[str, ...] = (),
    ) -> Written:
        """Write a table of this load, with comments, counting on the way; `parts` are columns it is partitioned by."""
        full = f"{self.schema}.`{table}`"

        def write(rows: DataFrame) -> DataFrame:
            rows.write.mode("error").format("parquet").option("compression", CODEC).partitionBy(*parts).saveAsTable(full)
            if comment:
                self.spark.sql(f"COMMENT ON TABLE {full} IS {_text(comment)}")
            return self.spark.table(full)

        return counting(describe(df, comments or {}), counts, write)

    def write_all(self, makers: Mapping[str, Callable[[], DataFrame]], at_once: int = 4) -> dict[str, DataFrame]:
        """Write tables that do not need each other, a few at a time."""
        return together({n: lambda n=n, make=make: self.write(n, make()).table for n, make in makers.items()}, at_once)

    def view(self, name: str, query: str) -> None:
        """A view of this load; `{schema}` in the query stands for its schema."""
        self.spark.sql(f"CREATE VIEW {self.schema}.`{name}` AS {query.format(schema=self.schema)}")

    def commit(self) -> str:
        """Make this load the current one. Returns its schema."""
        _point(self.spark, _pointer(self.name), f"SELECT {_text(self.schema)} AS carga")
        return self.schema


def _pointer(name: str) -> str:
    # Qualified, as a session may have made the schema of a load its own, see `use_current`.
    return f"default.`{name}`"


def _point(spark: SparkSession, view: str, query: str) -> None:
    """Make the view `view` mean `query` in one change of its catalogue entry; CREATE OR REPLACE would drop it first."""
    verb = "ALTER" if spark.catalog.tableExists(view) else "CREATE"
    spark.sql(f"{verb} VIEW {view} AS {query}")


def current_schema(spark: SparkSession, name: str) -> str | None:
    """The schema of the current load of `name`; None before the first one."""
    view = _pointer(name)
    return spark.table(view).first()["carga"] if spark.catalog.tableExists(view) else None


def current(spark: SparkSession, name: str) -> dict[str, DataFrame]:
    """The tables and views of the current load, all of one load."""
    schema = current_schema(spark, name)
    if schema is None:
        raise LookupError(f"no load of {name} was committed")
    return {t.name: spark.table(f"{schema}.`{t.name}`") for t in spark.catalog.listTables(schema) if not t.isTemporary}


def use_current(spark: SparkSession, name: str) -> None:
    """Let plain table names in this session's SQL mean those of the current load, until it is called again."""
    spark.catalog.setCurrentDatabase(current_schema(spark, name))


def retire(spark: SparkSession, name: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Drop the loads of `name`, finished or failed, that are neither current nor listed in `keep`, files included."""
    stay = {current_schema(spark, name), *keep}
    gone = [d.name for d in spark.catalog.listDatabases(f"{name}_*") if d.name not in stay]
    for schema in gone:
        spark.sql(f"DROP SCHEMA `{schema}` CASCADE")
    return gone


def replace_table(
    df: DataFrame, name: str, folder: str, comment: str | None = None, comments: Mapping[str, str] | None = None
) -> DataFrame:
    """Replace the rows, columns and comments of the catalogue table `name` in one step.

    The rows are written aside; then one catalogue entry, a view, is replaced. Who reads meanwhile has the old rows.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    publish(describe(df, comments or {}), path)
    view = _pointer(name)
    _point(spark, view, f"SELECT * FROM parquet.`{path}`")
    if comment:
        spark.sql(f"ALTER VIEW {view} SET TBLPROPERTIES ('comment' = {_text(comment)})")
    return spark.table(view)
