"""Session settings the library's plans want, and where rows are kept between the steps of a job."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders written since the innermost ``tidied`` began.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Settings that can be changed on a running session; they stay until the session ends. Sizes
    and partition counts are left to the cluster's own configuration.

    Typing a table of thirty columns makes one generated method larger than the JVM will
    compile, and interpreted it runs several times slower. With the limit at the JVM's own,
    Spark generates such a projection in small methods instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Where rows are kept between the steps of a job: the folder that the cluster names in
    ``spark.checkpoint.dir``, or, where that is unset, one beside the warehouse. A folder on a
    machine's own disk is refused unless the session runs on that machine alone."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    folder = (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch").rstrip("/")
    if not named and not spark.sparkContext.master.startswith("local") and _path(spark, folder)[1].getScheme() == "file":
        raise ValueError(f"{folder} is on one machine's disk; name a shared folder in spark.checkpoint.dir")
    return folder


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def settle(df: DataFrame, what: str = "rows", folder: str | None = None) -> DataFrame:
    """Rows that a job needs more than once, computed once: written to the shared folder (or the
    one given) and read back, so that they outlive a lost executor."""
    path = f"{(folder or shared_folder(df.sparkSession)).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored there."""
    p, fs = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder."""
    p, fs = _path(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of rows that nothing reads any more, through the store it is in."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_folders(df: DataFrame) -> set[str]:
    """Names of the folders a DataFrame's files are in."""
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def tidied(make: Callable[[], DataFrame | None], spark: SparkSession) -> DataFrame | None:
    """What ``make`` returns, a DataFrame or nothing. Folders that ``settle`` wrote on the way and that the
    result doesn't read are deleted; those it reads stay until its caller has stored it (and then
    may ``discard`` it), and go with an enclosing ``tidied`` whose result doesn't read them."""
    written: list[str] = []
    token = _written.set(written)
    try:
        result = make()
    finally:
        _written.reset(token)
    if written:
        needed = read_folders(result) if result is not None else set()
        outer = _written.get()
        for path in written:
            if path.rsplit("/", 1)[-1] not in needed:
                remove(spark, path)
            elif outer is not None:
                outer.append(path)
    return result


def discard(stored: DataFrame) -> None:
    """Deletes the folders of a stored DataFrame that its job has done with."""
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        remove(stored.sparkSession, folder)
