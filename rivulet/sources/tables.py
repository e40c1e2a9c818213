"""Sources: table scans, bound-parameter SELECTs (O1), JDBC reads, and a
scheduled stream source (O2)."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str,
                   names: tuple[str, ...] | list[str] = TABLES) -> None:
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def all_as_strings(df: DataFrame) -> DataFrame:
    """Every value read as text, as a result set read with getString."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def select_rows(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None,
                as_strings: bool = True) -> DataFrame:
    """O1: run one SELECT with bound named parameters (``:name``).

    Values are bound, never spliced into the text, so a value cannot change
    the statement. The result is lazy: Catalyst plans it with the rest of the
    caller's plan.
    """
    df = spark.sql(sql, args=dict(args) if args else None)
    return all_as_strings(df) if as_strings else df


def run_statement(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None,
                  as_strings: bool = True) -> tuple[DataFrame | None, dict | None]:
    """O1 + O9 for one whole statement: ``(rows, None)`` when Spark accepts
    it, else ``(None, failure)`` with ``error_code`` = ``SqlErrCod[<SQLSTATE>] ``
    and ``error_message`` = the statement text with ``'`` replaced by ``"``
    (what the reference reports). Parse and analysis errors surface here;
    errors while running surface at the action (use ``try_*`` functions for
    per-row problems so one bad row never fails the job)."""
    try:
        df = select_rows(spark, sql, args, as_strings)
        df.schema  # noqa: B018 - forces analysis now
        return df, None
    except PySparkException as e:
        state = e.getSqlState() or e.getCondition() or "UNKNOWN"
        return None, {"error_code": f"SqlErrCod[{state}] ", "error_message": sql.replace("'", '"'),
                      "error_condition": e.getCondition()}


def jdbc_rows(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None,
              query_timeout: int = 0, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, as_strings: bool = True) -> DataFrame:
    """O1 against a database: the SELECT runs in the database, split into
    ``num_partitions`` range reads on ``partition_column`` when given."""
    reader = (spark.read.format("jdbc").option("url", url)
              .option("dbtable", f"({query}) q").option("queryTimeout", str(int(query_timeout))))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    df = reader.load()
    return all_as_strings(df) if as_strings else df


def run_with_timeout(spark: SparkSession, action: Callable[[], Any], seconds: float) -> Any:
    """Run an action; cancel its Spark jobs after ``seconds`` (0 = no limit).

    The reference's statement timeout, for a Spark job: a job group plus a
    cancel from the caller.
    """
    if not seconds:
        return action()
    sc = spark.sparkContext
    group = f"rivulet-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "rivulet timed action", interruptOnCancel=True)
    timer = threading.Timer(seconds, lambda: sc.cancelJobGroup(group))
    timer.start()
    try:
        return action()
    finally:
        timer.cancel()
        sc.setLocalProperty("spark.jobGroup.id", None)


def stream_source(spark: SparkSession, path: str, schema: StructType | str,
                  file_glob: str | None = None, fixed: Mapping[str, Any] | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """O2: a stream of records from new Parquet files under ``path``.

    The period is the caller's ``trigger(processingTime=...)``; fixed
    attributes (``loop_value=0, loop_limit=10`` in the loop flow) are literals.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(path)
    return with_fixed(df, fixed)


def with_fixed(df: DataFrame, fixed: Mapping[str, Any] | None) -> DataFrame:
    if not fixed:
        return df
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in fixed.items()})
