"""Session settings for applications; library functions never create a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC dates and adaptive execution; ``conf`` overrides win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ampledger-")


class Staging:
    """The staged paths of one scope."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        """Delete what the scope still owns."""
        while self.paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SCOPES: ContextVar[tuple[Staging, ...]] = ContextVar("staging", default=())
_FOLDERS: dict[tuple[str, str], str] = {}


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """A scope that owns what is staged inside it and deletes that at its end, also on failure.

    Frames that read staged tables must be stored or used up before; see
    :func:`store`. Operators open scopes of their own for the tables that their
    result does not read. What no scope owns goes when the application ends.
    """
    scope = Staging()
    before = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(before)
        scope.release(spark)


def store(spark: SparkSession, make: Callable[[], DataFrame], path: str, mode: str = "errorifexists") -> DataFrame:
    """Write the frame that ``make`` returns as Parquet, delete what was staged for it, and read it back."""
    with staging(spark):
        frame = make()
        schema = frame.schema
        frame.write.mode(mode).parquet(path)
    return spark.read.schema(schema).parquet(path)


def scratch_path(spark: SparkSession, name: str, outlive: bool = False) -> str:
    """A fresh path for a staged table, under the session's shared checkpoint folder.

    The innermost open scope owns it, or with ``outlive`` the one around that.
    A temporary folder is used only where ``spark.checkpoint.dir`` is unset,
    as in local tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    path = f"{_folder(spark, base.rstrip('/'))}/{name}-{uuid.uuid4().hex}"
    owners = _SCOPES.get()[: -1 if outlive else None]
    if owners:
        owners[-1].paths.append(path)
    return path


def _folder(spark: SparkSession, base: str) -> str:
    """The application's own folder below ``base``; Hadoop deletes it when the application ends."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _FOLDERS:
        folder = f"{base}/staged-{key[0]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[key] = folder
    return _FOLDERS[key]
