"""All-or-nothing append of one batch to several targets.

Spark files have no multi-table transaction, so visibility is what is made
atomic:

1. all targets are prepared first: a frame that cannot be analysed, planned or
   stored is found before anything is written;
2. each attempt writes its targets to folders of its own, never over another's
   (``atomic_append``: a job per target, ``root/<target>/batch_id=<id>/attempt=<name>/``;
   ``append_routes``: one job and one scan for all targets of one input,
   ``root/_routed/batch_id=<id>/attempt=<name>/target=<name>/``);
3. only when every write succeeded is one commit put into the log
   (``sinks/txlog.py``), which names the batch and the attempt: the single, last,
   visible step. Of attempts that race for a batch the first commit counts;
4. readers (``read_committed``, ``read_routed``) keep only attempts that the log names.

A batch that the log lists is done: appending it again changes nothing. A failure
at any target leaves no commit, its attempt's folders are deleted, and what was
committed before stays as it is. Row counts come from ``observe`` on the write
itself, not from a second pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import non_blank_trimmed_lines
from rivulet.operators.routing import UNMATCHED, mark_failed, route_column, sql_error_code
from rivulet.session import materialize
from rivulet.sinks.txlog import LOG, Log, files_of

BATCH_COL = "batch_id"
ATTEMPT_COL = "attempt"
ROUTED = "_routed"
TARGET_COL = "target"


def _target_name(name: str, batch_id, attempt: str) -> str:
    return f"{name}/{BATCH_COL}={batch_id}/{ATTEMPT_COL}={attempt}"


def _error(e: Exception) -> tuple[str, str]:
    """Code and whole message of a failure, as the failure record has them."""
    code = (e.getSqlState() or e.getCondition()) if isinstance(e, PySparkException) else None
    return sql_error_code(code or type(e).__name__), str(e).replace("'", '"')


def committed_attempts(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed batch: version, batch_id_value, attempt_value,
    stream, seq, layout, rows."""
    return Log(spark, root).entries()


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batch ids that are committed (one row per batch)."""
    return committed_attempts(spark, root).select("batch_id_value")


def _prepare(df: DataFrame) -> DataFrame:
    """The frame, if it can be analysed and planned and its columns be stored."""
    names = [c.lower() for c in df.columns]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"columns that occur twice: {twice}")
    df._jdf.queryExecution().executedPlan()
    return df


class _Append:
    """One attempt of a batch: what both kinds of append share."""

    def __init__(self, spark: SparkSession, root: str, batch_id):
        self.log, self.batch_id = Log(spark, root), str(batch_id)
        self.root = root.rstrip("/")
        self.attempt = "a" + uuid.uuid4().hex[:16]
        self.name = "log"          # what is being done, for the failure record
        self.folders: list[str] = []

    def outcome(self, **kw) -> dict:
        return {"batch_id": self.batch_id, "success": True, "insert_successfully_done": 0, "rows": {}, "failed_target": None,
                "error_code": None, "error_message": None} | kw

    def folder(self, name: str) -> str:
        own = _target_name(name, self.batch_id, self.attempt)
        self.folders.append(own)
        return f"{self.root}/{own}"

    def run(self, write: Callable[[], dict[str, int]], layout: str, stream: str | None, seq: int | None) -> dict:
        try:
            done = self.log.find(self.batch_id)
            if done is None:
                rows = write()
                self.name = "log"
                done = self.log.commit(self.batch_id, self.attempt, rows, layout, stream, seq)
                if done["attempt_value"] != self.attempt:
                    self.drop()    # another attempt was first
            return self.outcome(insert_successfully_done=len(done["rows"]), rows=dict(done["rows"]))
        except Exception as e:  # noqa: BLE001 - any failure is routed, like a rollback
            code, said = _error(e)
            self.drop()
            return self.outcome(success=False, failed_target=self.name, error_code=code, error_message=said)

    def drop(self) -> None:
        for own in self.folders:
            self.log.files.delete(own)


def atomic_append(spark: SparkSession, targets: Mapping[str, DataFrame | Callable[[], DataFrame] | None], root: str, batch_id,
                  fmt: str = "parquet", stream: str | None = None, seq: int | None = None) -> dict:
    """Write every target for ``batch_id``, then commit.

    A target is a frame or a function that makes one (a SELECT, say); all are
    made and planned before the first is written. Returns ``{batch_id, success,
    insert_successfully_done, rows, failed_target, error_code, error_message}``;
    ``insert_successfully_done`` is the number of targets written (the true count,
    see SURVEY 2.10). A batch that is committed already is left alone and
    reported as it was.
    """
    append = _Append(spark, root, batch_id)

    def write() -> dict[str, int]:
        if not targets or next(iter(targets.values())) is None:
            raise ValueError("the first target is required")
        frames = {}
        for name, target in targets.items():
            append.name = name
            if target is not None:   # (a blank statement slot is skipped)
                frames[name] = _prepare(target() if callable(target) else target)
        rows = {}
        for name, df in frames.items():
            append.name = name
            obs = Observation(f"rows_{name}_{append.attempt}")
            df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").format(fmt).save(append.folder(name))
            rows[name] = int(obs.get["n"])
        return rows

    return append.run(write, "folders", stream, seq)


def append_routes(spark: SparkSession, df: DataFrame, routes: Mapping[str, Column], root: str, batch_id, multi: bool = True,
                  unmatched: str | None = UNMATCHED, columns: Mapping[str, Sequence[str]] | None = None,
                  stream: str | None = None, seq: int | None = None) -> dict:
    """O7 + O3 in one pass: the records of ``df`` go to every target whose
    predicate is true (``multi=False``: the first one; none: ``unmatched``, or
    nowhere if that is None), in one job with one scan however many targets there
    are. ``columns``: the columns that a target keeps (the others are null in its
    files, which costs next to nothing). Result as ``atomic_append``'s."""
    append = _Append(spark, root, batch_id)

    def write() -> dict[str, int]:
        if not routes:
            raise ValueError("no target")
        append.name = ROUTED
        other = unmatched or UNMATCHED
        if TARGET_COL in df.columns:
            raise ValueError(f"a column is named {TARGET_COL}")
        tagged = route_column(df, routes, multi, other, TARGET_COL)
        if unmatched is None:
            tagged = tagged.where(F.col(TARGET_COL) != other)
        for c in df.columns if columns else ():
            without = [name for name, kept in columns.items() if c not in kept]
            if without:
                tagged = tagged.withColumn(c, F.when(~F.col(TARGET_COL).isin(without), F.col(f"`{c}`")))
        names = [*routes, *([unmatched] if unmatched else [])]
        obs = Observation(f"routed_{append.attempt}")
        counts = [F.count(F.when(F.col(TARGET_COL) == name, 1)).alias(f"n{i}") for i, name in enumerate(names)]
        _prepare(tagged).observe(obs, *counts).write.mode("errorifexists").partitionBy(TARGET_COL).parquet(append.folder(ROUTED))
        return {name: int(obs.get[f"n{i}"]) for i, name in enumerate(names)}

    return append.run(write, ROUTED, stream, seq)


def ensure_root(spark: SparkSession, root: str) -> None:
    """Create the append root, so that readers find it before the first commit."""
    files_of(spark, root).make_folder(LOG)


def _committed(spark: SparkSession, root: str, data: DataFrame, layout: str) -> DataFrame:
    # The casts are on the log's side: partition columns are compared as they are.
    ok = committed_attempts(spark, root).where(F.col("layout") == layout).select(
        F.col("batch_id_value").cast(data.schema[BATCH_COL].dataType).alias("_batch"), F.col("attempt_value").alias("_attempt"))
    on = (data[BATCH_COL] == ok["_batch"]) & (data[ATTEMPT_COL] == ok["_attempt"])
    return data.join(ok, on, "left_semi").drop(ATTEMPT_COL)


def read_committed(spark: SparkSession, root: str, name: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A target as readers see it: only the attempts that the log names (a
    semi-join on the partition columns, so uncommitted folders are pruned; Spark
    decides by the log's size whether to broadcast it)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return _committed(spark, root, reader.load(f"{root.rstrip('/')}/{name}"), "folders")


def read_routed(spark: SparkSession, root: str, name: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A target of ``append_routes`` (only its folders are read), or all of them
    with their column ``target``."""
    data = spark.read.parquet(f"{root.rstrip('/')}/{ROUTED}")
    data = data.withColumn(TARGET_COL, F.col(TARGET_COL).cast("string"))   # (a folder may be named like a number)
    if name is not None:
        data = data.where(F.col(TARGET_COL) == name)
    out = _committed(spark, root, data, ROUTED)
    out = out if name is None else out.drop(TARGET_COL)
    return out.select(*columns) if columns else out


def route_outcome(records: DataFrame, result: Mapping, statement: str | None = None) -> DataFrame:
    """O9 for a whole append: the input records with ``route``; on failure
    also ``error_code`` (``SqlErrCod[<code>] ``) and ``error_message``: the
    statement (or the target that failed) and the error, as data."""
    said = f"{statement or result['failed_target']}: {result['error_message']}"
    return mark_failed(records, F.lit(bool(result["success"])), result["error_code"] or "", F.lit(said))


def append_lines(spark: SparkSession, records: DataFrame, content: str,
                 targets: Mapping[str, Callable[[DataFrame], DataFrame]],
                 root: str, batch_id, keep: tuple[str, ...] = ()) -> dict:
    """Each non-blank trimmed line of the content is one data row; each
    target's function picks and parses its lines (e.g. ``from_csv`` with a
    schema) from the frame of lines; all targets are then appended
    all-or-nothing. As every line is one statement in content mode, the
    reported ``insert_successfully_done`` is the number of rows written."""
    lines = records.select(*keep, F.explode(non_blank_trimmed_lines(content)).alias("line"))
    # every target reads the same lines: split the content once, into the shared
    # folder, from which a lost task reads it again
    lines = materialize(lines, "append_lines")
    res = atomic_append(spark, {name: (lambda fn=fn: fn(lines)) for name, fn in targets.items()}, root, batch_id)
    if res["success"]:
        res["insert_successfully_done"] = sum(res["rows"].values())
    return res
