"""Helpers the operators share: text keys, scratch tables in the shared folder, fixed hash folds."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, suppress
from pathlib import Path
from threading import Timer
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def importable(spark: SparkSession) -> SparkSession:
    """A local session's Python workers find this package where the driver found it. Clusters have it installed."""
    context, root = spark.sparkContext, str(Path(__file__).resolve().parents[2])
    known = context.environment.get("PYTHONPATH", "")
    if context.master.startswith("local[") and root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. lower() does that on pure ASCII and is far cheaper than translate()."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


#: Rows of a file of a stored table whose size is known beforehand.
FILE_ROWS = 1 << 14


def files_for(rows: int) -> int:
    return max(1, -(-rows // FILE_ROWS))


def stored(rows: DataFrame, path: str, about: int | None = None) -> DataFrame:
    """Rows written to the shared folder and read back: the lineage ends here, and a lost executor loses nothing.

    With ``about``, the number of rows to expect, files hold about :data:`FILE_ROWS` rows. Else each task writes its own,
    and a small table in many partitions becomes as many tiny files; on a local folder each of them costs the executor
    several child processes (chmod), which for a moment share its memory.
    """
    if about is not None:
        rows = rows.repartition(files_for(about))
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def rebalanced(rows: DataFrame) -> DataFrame:
    """Rows to store whose number is not known: one more shuffle, whose partitions Spark merges to its advisory size."""
    return rows.hint("rebalance")


def private(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, so that no further column of the input can clash with those an operator adds."""
    return rows.select(*(F.col(f"`{name}`") for name in columns))


def own_names(rows: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of the rows has, in any spelling Spark takes for the same."""
    taken = {c.lower() for c in rows.columns}
    mark = "_own"
    while any(f"{mark}_{name}" in taken for name in names):
        mark += "_"
    return [f"{mark}_{name}" for name in names]


def same_row(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


#: Seconds that a worker keeps what it built after the last task that used it.
IDLE = 3.0

_KEPT: dict[Any, Any] = {}
_GOING: list[Timer] = []


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """What a worker builds once for all its tasks. It keeps one such value; the one before goes first, so that two are
    never held."""
    value = _KEPT.get(key)
    if value is None:
        _KEPT.clear()
        value = _KEPT[key] = build()
        trim()
    return value


@contextmanager
def in_use() -> Iterator[None]:
    """Around a task's work with a kept value: the value stays for the tasks that follow at once. Spark's workers live on
    between jobs, so it goes after :data:`IDLE` seconds without a task."""
    while _GOING:
        _GOING.pop().cancel()
    try:
        yield
    finally:
        timer = Timer(IDLE, release)
        timer.daemon = True
        _GOING.append(timer)
        timer.start()


def release() -> None:
    """A task that needs no kept value lets go of what a job before has left."""
    if _KEPT:
        _KEPT.clear()
        trim()


def trim() -> None:
    """Hands freed memory back to the system, where the C library has a way to: it may keep it else, and a worker lives on."""
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)
