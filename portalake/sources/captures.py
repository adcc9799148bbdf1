"""Landed portal responses, one row per response body."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A capture is one logical fetch: all pages of it share capture_id.
CAPTURE_SCHEMA = T.StructType([
    T.StructField("capture_id", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("fmt", T.StringType()),               # json | xml
    T.StructField("page", T.IntegerType()),
    T.StructField("num_of_rows", T.IntegerType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("captured_at", T.TimestampType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("retry_after", T.StringType()),
    T.StructField("body", T.BinaryType()),
])


#: Stored beside a capture, so that bodies need not be read to tell whether they are known.
FINGERPRINT = "fingerprint"


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table of captures. Laid out by service and operation, a read of one table
    opens only its own files."""
    return spark.read.schema(T.StructType([*CAPTURE_SCHEMA, T.StructField(FINGERPRINT, T.LongType())])).parquet(path)


def write_captures(captures: DataFrame, path: str, mode: str = "append") -> None:
    """Store captures by service and operation, with a hash of each body; AQE evens out the files,
    hot operations included. Within a file they are in order of capture time, so that a reader
    that wants some time passes over the rest."""
    (captures.withColumn(FINGERPRINT, F.xxhash64("body")).hint("rebalance", "service", "operation")
     .sortWithinPartitions("service", "operation", "captured_at")
     .write.mode(mode).partitionBy("service", "operation").parquet(path))


#: Ends the name of a file beside a body that holds its request record.
RECORD = ".request.json"
RECORD_SCHEMA = T.StructType([f for f in CAPTURE_SCHEMA if f.name in ("params", "captured_at", "http_status", "retry_after", "num_of_rows")])


def _decoded(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _inside(path: Column, root: str) -> Column:
    """The parts of a file's path below the root. The path comes back with a scheme and maybe encoded,
    so what stands before the root is cut by its place, and the root is taken literally. A folder
    may be written as ``name=value``; in such names Spark encodes what a folder can't be called."""
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root.rstrip("/")) + "/"
    plain = F.when(F.locate(folder, path) > 0, path).otherwise(_decoded(path))
    parts = F.split(F.substr(plain, F.locate(folder, plain) + F.lit(len(folder))), "/", -1)
    named = r"^(service|operation|capture_id|page)="
    return F.transform(parts, lambda p: F.when(p.rlike(named), _decoded(F.regexp_replace(p, named, ""))).otherwise(p))


def _place(path: Column, root: str) -> list[Column]:
    """Service, operation, capture and page that a path names. The page is what the file's name begins
    with, or a folder ``page=`` of its own."""
    inside = _inside(path, root)
    own = path.rlike(r"/page(=|%3D)[^/]*/[^/]*$")
    inside = F.when(own, F.slice(inside, F.lit(1), F.size(inside) - 1)).otherwise(inside)
    size = F.size(inside)
    return [F.element_at(inside, 1).alias("service"), F.array_join(F.slice(inside, F.lit(2), size - 3), "/").alias("operation"),
            F.element_at(inside, -2).alias("capture_id"),
            F.regexp_extract(F.element_at(inside, -1), r"^(\d+)", 1).try_cast("int").alias("page")]


def read_bodies(spark: SparkSession, root: str, fmt: str, num_of_rows: int = 1000, records: bool = False) -> DataFrame:
    """Captures from a folder of response files laid out as
    ``<service>/<operation...>/<capture_id>/<page>.<suffix>``, or with folders ``service=``,
    ``operation=``, ``capture_id=`` and ``page=``. The operation may itself contain slashes. The
    file time stands in for the capture time. A file whose name does not begin with a number has
    no page; the audit then refuses its capture.

    With ``records`` a file ``<page>.request.json`` beside a body says how it was asked for: an object
    of ``params``, ``captured_at``, ``http_status``, ``retry_after`` and ``num_of_rows``, any of them.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .where(~F.col("path").endswith(RECORD)))
    found = files.select(
        *_place(F.col("path"), root),
        F.lit(fmt).alias("fmt"),
        F.lit(num_of_rows).alias("num_of_rows"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.col("modificationTime").alias("captured_at"),
        F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("retry_after"),
        F.col("content").alias("body"),
    ).select(*CAPTURE_SCHEMA.names)
    if not records:
        return found
    said = (spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{RECORD}").option("multiLine", "true").json(root)
            .select(*_place(F.col("_metadata.file_path"), root), *RECORD_SCHEMA.names))
    return with_records(found, said)


def with_records(captures: DataFrame, records: DataFrame) -> DataFrame:
    """Captures with what request records say of them, by service, operation, capture and page: any of
    ``params``, ``captured_at``, ``http_status``, ``retry_after``, ``num_of_rows``. A capture without a
    record stays as it is; of several records of one page the latest by time counts."""
    place = ["service", "operation", "capture_id", "page"]
    said = [c for c in RECORD_SCHEMA.names if c in records.columns]
    time = F.coalesce(F.col("captured_at"), F.timestamp_seconds(F.lit(0))) if "captured_at" in said else F.lit(0)
    last = records.groupBy(*place).agg(F.max_by(F.struct(*said), time).alias("_said"))
    same = None
    for c in place:
        test = captures[c].eqNullSafe(last[c])
        same = test if same is None else same & test
    joined = captures.join(last, same, "left")
    return joined.select(*[F.coalesce(F.col("_said")[c].cast(captures.schema[c].dataType), captures[c]).alias(c) if c in said else captures[c]
                           for c in captures.columns])
