"""Scans: parquet, object store, CSV, catalog table, JSON requests."""

from __future__ import annotations

import csv
import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampledger.operators.ordering import first_rows
from ampledger.schema import READING_SCHEMA, REQUEST_SCHEMA, TELEMETRY_SCHEMA


def read_telemetry(spark: SparkSession, path: str, schema: T.StructType = TELEMETRY_SCHEMA) -> DataFrame:
    """Parquet with the declared schema, so that no footer is read to infer one. For other layouts see :func:`read_raw_telemetry`."""
    return spark.read.schema(schema).parquet(path)


def read_raw_telemetry(
    spark: SparkSession, path: str, schema: T.StructType = TELEMETRY_SCHEMA, time_names: tuple[str, ...] = ("event_ts", "timestamp")
) -> DataFrame:
    """Parquet files as they are, of one or several layouts, as the declared columns and types.

    The footers are merged by Spark; where they don't agree (text and
    timestamp, int and long), the files are divided until those of a part do,
    and each layout is read by itself and cast. Layouts that change from day
    to day thus take few passes over the footers. The time may have any of
    ``time_names``. Columns that a file lacks are null; see ``ensure_key`` for
    the row key. Text that can't be read as its type is null. Columns that the
    schema doesn't have are left out. A folder without files raises.
    """
    files = _files(spark, path, "*.parquet")
    if not files:
        raise ValueError(f"no parquet files in {path}")
    base = {} if len(files) == 1 else {"basePath": path}
    layouts: dict[str, list[str]] = {}
    parts = [files]
    while parts:
        part = parts.pop()
        try:
            found = spark.read.options(mergeSchema="true", **base).parquet(*part).schema
        except (PySparkException, Py4JJavaError) as e:
            if len(part) == 1 or "CANNOT_MERGE" not in str(e):
                raise
            half = len(part) // 2
            parts += [part[half:], part[:half]]
            continue
        layouts.setdefault(found.json(), []).extend(part)
    frames = []
    for layout, some in layouts.items():
        found = T.StructType.fromJson(json.loads(layout))
        frames.append(_declared(spark.read.options(**base).schema(found).parquet(*some), schema, time_names))
    return reduce(DataFrame.unionByName, frames)


def _files(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """The data files below a path, as any Spark reader lists them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).inputFiles()
    return sorted(unquote(f) for f in listed)


def _declared(df: DataFrame, schema: T.StructType, time_names: tuple[str, ...]) -> DataFrame:
    """The columns of ``schema``, cast from whatever types the frame has."""
    columns = []
    for field in schema:
        names = [n for n in (time_names if field.name == time_names[0] else (field.name,)) if n in df.columns]
        values = [_readable(F.col(f"`{n}`"), df.schema[n].dataType, field.dataType) for n in names]
        columns.append((F.coalesce(*values) if values else F.lit(None).cast(field.dataType)).alias(field.name))
    return df.select(*columns)


def _readable(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(kind, T.StringType):
        text = F.trim(value)
        return F.try_to_timestamp(text).cast(wanted) if isinstance(wanted, T.TimestampType) else text.try_cast(wanted)
    if isinstance(wanted, T.StringType) or isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return value.cast(wanted)
    return value.try_cast(wanted)


#: Headers that are read at a time.
HEADER_JOBS = 16
#: Text of a CSV row that has more or fewer cells than its header.
RAGGED = "_ragged"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TELEMETRY_SCHEMA,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
) -> DataFrame:
    """CSV columns by the names in each file's own header, in any order, as the declared types.

    Columns that the schema doesn't have are left out. A missing row key is
    left to ``ensure_key``; any other missing column raises. A cell that can't
    be read as its type is null here, and its row is in :func:`csv_rejects`; a
    row with more or fewer cells than its header is there only.
    """
    groups = _csv_groups(spark, path, schema, timestamp_format)
    known = [f for f in schema if any(f.name in cells for _, cells in groups)]
    frames = []
    for raw, cells in groups:
        whole = raw.filter(F.col(RAGGED).isNull())
        frames.append(whole.select(*(cells.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in known)))
    return reduce(DataFrame.unionByName, frames)


def csv_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TELEMETRY_SCHEMA,
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
) -> DataFrame:
    """The rows, as text, with a filled cell that can't be read as its type, or with more or fewer cells than their header.

    ``_ragged`` holds the whole line of the latter, else null. Columns that a
    file's header lacks are null.
    """
    frames = []
    for raw, cells in _csv_groups(spark, path, schema, timestamp_format):
        bad = F.col(RAGGED).isNotNull()
        for name, value in cells.items():
            bad = bad | (F.trim(F.col(f"`{name}`")) != "") & value.isNull()
        frames.append(raw.filter(F.coalesce(bad, F.lit(False))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _csv_groups(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str) -> list[tuple[DataFrame, dict[str, Column]]]:
    """For each header that occurs, the text rows of its files and the declared columns made of them."""
    files = _files(spark, path, "*")
    if not files:
        raise ValueError(f"no CSV files in {path}")
    # A file's header is its first line; each is a job of one task, a few at a time.
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        lines = list(pool.map(lambda f: spark.read.text(f).head(1), files))
    by_header: dict[str, list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            by_header.setdefault(line[0]["value"].removeprefix("\ufeff"), []).append(file)
    if not by_header:
        raise ValueError(f"the CSV files in {path} are empty")
    groups = []
    for header, some in by_header.items():
        names = next(csv.reader([header]))
        absent = [f.name for f in schema if f.name not in names and f.name != "event_id"]
        if absent:
            raise ValueError(f"the CSV header of {some[0]} lacks {absent}")
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RAGGED]])
        # All cells are parsed, so that a row shows how many it has.
        raw = spark.read.options(header=True, columnNameOfCorruptRecord=RAGGED, columnPruning=False).schema(text).csv(some)
        groups.append((raw, _csv_cells(names, schema, timestamp_format)))
    return groups


def _csv_cells(names: list[str], schema: T.StructType, timestamp_format: str) -> dict[str, Column]:
    cells = {}
    for field in schema:
        if field.name in names:
            text = F.trim(F.col(f"`{field.name}`"))
            if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
                cells[field.name] = F.try_to_timestamp(text, F.lit(timestamp_format)).cast(field.dataType)
            else:
                cells[field.name] = text.try_cast(field.dataType)
    return cells


def read_object_store(
    spark: SparkSession, account: str, container: str, path: str, sas_token: str | None = None
) -> DataFrame:
    """Telemetry parquet in blob storage; the token goes into the session conf."""
    host = f"{account}.blob.core.windows.net"
    if sas_token:
        spark.conf.set(f"fs.azure.sas.{container}.{host}", sas_token)
    return read_telemetry(spark, f"wasbs://{container}@{host}/{path.lstrip('/')}")


def read_table_first(spark: SparkSession, table: str, n: int = 30_000) -> DataFrame:
    """The first ``n`` rows of a processed table in event order."""
    return first_rows(spark.table(table), n)


def parse_requests(df: DataFrame, body: str = "body", keys: list[str] | None = None) -> DataFrame:
    """One row per reading of a JSON request, with its position.

    A body that does not parse, or holds no readings, gives one row with a NULL position.
    """
    keys = keys or [c for c in df.columns if c != body]
    readings = F.from_json(F.col(body), REQUEST_SCHEMA)["readings"]
    return df.select(*keys, F.posexplode_outer(readings).alias("position", "reading")).select(
        *keys, "position", "reading.*"
    )


def _incomplete():
    missing = F.lit(False)
    for field in READING_SCHEMA.fields:
        missing = missing | F.col(field.name).isNull()
    return missing


def accepted_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~_incomplete())


def rejected_readings(parsed: DataFrame) -> DataFrame:
    """Malformed bodies and readings with a missing field."""
    return parsed.filter(_incomplete())
