"""What jobs beside a stream make of tables that grow by one folder per micro-batch.

Such a job takes the finished batches up to a number and writes what it makes of them into a
run, a folder of its own. Then one small file, put in place as a whole and only if there is
none of that name, says which runs stand for all batches up to that number. Readers open the
runs of the highest such commit and the finished batches after it: they see the table from
before or from after, never both or neither. A job that stops half-way leaves a run that no
commit names; of two jobs at once each makes a commit that is whole in itself.

``take`` makes one run of everything (for small tables that can be combined), ``compact`` adds
runs and rewrites only the small ones among them (for tables of rows).
"""

import json
import uuid
from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.sources import sinks

Combine = Callable[[DataFrame], DataFrame]


class Run(NamedTuple):
    folder: str
    batches: int


class Commit(NamedTuple):
    """``upto``: the last batch that the runs stand for."""

    upto: int
    runs: tuple[Run, ...]


NONE = Commit(-1, ())


def made_of(path: str) -> str:
    """Where runs and commits of a table lie."""
    return f"{path}_snapshots"


def commits(spark: SparkSession, made: str) -> list[int]:
    return sinks.folders(spark, f"{made}/commits", "upto")


def read_commit(spark: SparkSession, made: str, number: int) -> Commit:
    runs = json.loads(sinks.read_file(spark, f"{made}/commits/upto={number}"))
    return Commit(number, tuple(Run(*run) for run in runs))


def newest(spark: SparkSession, made: str, upto: int | None = None) -> Commit:
    """The highest commit, or the highest one up to a batch."""
    numbers = [n for n in commits(spark, made) if upto is None or n <= upto]
    return read_commit(spark, made, numbers[-1]) if numbers else NONE


def commit(spark: SparkSession, made: str, found: Commit) -> bool:
    """Put a commit in place, unless another job has made one of that number."""
    return sinks.put_file(spark, f"{made}/commits/upto={found.upto}", json.dumps(found.runs))


def ready(spark: SparkSession, path: str, after: int, contiguous: bool = True) -> list[int]:
    """The batches after a number that a job may take: finished ones, up to the first that isn't.

    Batches are written one after the other, so one that is being written, or that will be
    written again after a failure, is the last. Where every batch writes a folder a missing
    number is one that isn't there yet.
    """
    done = sinks.finished(spark, path)
    there = [n for n in sinks.folders(spark, path, "batch_id") if n > after]
    found = []
    for n in there:
        if n not in done or (contiguous and n != after + 1 + len(found)):
            break
        found.append(n)
    return found


def batches(
    spark: SparkSession, path: str, schema: T.StructType, numbers: list[int], lines: bool = False, by_day: bool = False
) -> DataFrame:
    """The rows of some finished batches; with ``by_day`` also the day their folders are named by."""
    folders = [f"{path}/batch_id={n}" for n in numbers]
    return _read(spark, path, folders, schema, by_day, lines)


def _read(
    spark: SparkSession, base: str, folders: list[str], schema: T.StructType, by_day: bool, lines: bool = False
) -> DataFrame:
    full = T.StructType([*schema.fields, *([T.StructField("day", T.DateType())] if by_day else [])])
    if not folders:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("basePath", base)
    found = reader.text(folders) if lines else reader.parquet(*folders)
    return found.select(*full.fieldNames())


def rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lines: bool = False,
    upto: int | None = None,
    by_day: bool = False,
) -> DataFrame:
    """The table: the newest commit's runs and the finished batches after it (up to ``upto``)."""
    made = made_of(path)
    found = newest(spark, made, upto)
    after = [n for n in sinks.finished(spark, path) if n > found.upto and (upto is None or n <= upto)]
    later = batches(spark, path, schema, after, lines, by_day)
    if not found.runs:
        return later
    taken = _read(spark, made, [f"{made}/{run.folder}" for run in found.runs], schema, by_day)
    return taken.unionByName(later) if after else taken


def rows_since(spark: SparkSession, path: str, schema: T.StructType, time: str, first: date) -> DataFrame:
    """The rows from a day on, where runs are laid out by day and batches aren't: the folders of
    earlier days are not opened."""
    made, since = made_of(path), F.lit(first)
    found = newest(spark, made)
    after = [n for n in sinks.finished(spark, path) if n > found.upto]
    taken = _read(spark, made, [f"{made}/{run.folder}" for run in found.runs], schema, True)
    later = batches(spark, path, schema, after).filter(F.col(time) >= since)
    return taken.filter(F.col("day") >= since).select(*schema.fieldNames()).unionByName(later)


def days(spark: SparkSession, path: str) -> list[date]:
    """The days of a table laid out by day, the newest first, from its folders' names alone."""
    made = made_of(path)
    runs = [f"{made}/{run.folder}" for run in newest(spark, made).runs]
    return sinks.days(spark, f"{path}/batch_id=*", *runs)


def take(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    combine: Combine,
    lines: bool = False,
    clear: bool = False,
    contiguous: bool = True,
) -> int | None:
    """Combine everything so far into one run; with ``clear`` remove what is no longer read.

    ``combine`` gets rows and gives fewer of the same kind, so that it may be applied to its
    own result. Nothing is taken if there is no finished batch after the newest commit.
    """
    made = made_of(path)
    numbers = ready(spark, path, newest(spark, made).upto, contiguous)
    if numbers:
        upto = numbers[-1]
        folder = _new_run(upto)
        combined = combine(rows(spark, path, schema, lines, upto)).select(*schema.fieldNames())
        combined.write.parquet(f"{made}/{folder}")
        _put(spark, made, Commit(upto, (Run(folder, upto + 1),)))
    if clear:
        tidy(spark, path, made)
    found = newest(spark, made)
    return None if found is NONE else found.upto


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    by_day: bool = False,
    lines: bool = False,
    made: str | None = None,
    change: Combine | None = None,
    combine: Combine | None = None,
    time: str = "timestamp",
    key: str = "id",
    clear: bool = False,
) -> int | None:
    """Write the finished batches since the newest commit into one run, in files of bounded size.

    Runs at the end that stand for no more than twice as many batches are rewritten with them,
    so that a row is rewritten a few times in all and there are only a few runs. ``change``
    makes the rows of the table in ``made`` out of those of the batches, ``combine`` fewer rows
    of the same kind out of those that are written together. Rows are laid out by the day of
    ``time`` and dealt by ``key``.
    """
    made = made or made_of(path)
    before = newest(spark, made)
    numbers = ready(spark, path, before.upto)
    if numbers:
        new = batches(spark, path, sinks.LINES if lines else schema, numbers, lines)
        new = change(new) if change else new
        kept, count, again = list(before.runs), len(numbers), []
        while kept and kept[-1].batches <= 2 * count:
            again.append(kept.pop())
            count += again[-1].batches
        old = _read(spark, made, [f"{made}/{run.folder}" for run in again], schema, False)
        table = new.select(*schema.fieldNames())
        table = table.unionByName(old) if again else table
        table = combine(table) if combine else table
        folder = _new_run(numbers[-1])
        sinks.write_sized(table, f"{made}/{folder}", by_day, sinks.FILE_ROWS, time, key)
        _put(spark, made, Commit(numbers[-1], (*kept, Run(folder, count))))
    if clear:
        tidy(spark, path, made)
    found = newest(spark, made)
    return None if found is NONE else found.upto


def _new_run(upto: int) -> str:
    return f"run={upto}-{uuid.uuid4().hex}"


def _put(spark: SparkSession, made: str, found: Commit) -> None:
    if not commit(spark, made, found):
        sinks.remove(spark, f"{made}/{found.runs[-1].folder}")


def tidy(spark: SparkSession, path: str, made: str) -> None:
    """Remove what the commit before the newest one no longer needs: readers that began before
    the newest one was made go on reading. Runs that no commit names are left alone, as a job
    may be writing them."""
    numbers = commits(spark, made)
    if len(numbers) < 2:
        return
    old, last = numbers[:-2], [read_commit(spark, made, n) for n in numbers[-2:]]
    needed = {run.folder for found in last for run in found.runs}
    for number in old:
        for run in read_commit(spark, made, number).runs:
            if run.folder not in needed:
                sinks.remove(spark, f"{made}/{run.folder}")
        sinks.remove(spark, f"{made}/commits/upto={number}")
    for number in sinks.folders(spark, path, "batch_id"):
        if number <= last[0].upto:
            sinks.remove(spark, f"{path}/batch_id={number}")


def table_rows(spark: SparkSession, made: str, schema: T.StructType, by_day: bool = False) -> DataFrame:
    """The rows of the newest commit alone."""
    found = newest(spark, made)
    return _read(spark, made, [f"{made}/{run.folder}" for run in found.runs], schema, by_day)
