"""Session helpers: a session for local runs, shared work folders, bounded reads to the driver."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from sievestream.files import delete


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sievestream")
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}
_SCOPE: ContextVar[list[str] | None] = ContextVar("sievestream-work", default=None)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared checkpoint folder (a temporary one only in local mode without a setting)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        if context.applicationId not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="sievestream-")
            atexit.register(shutil.rmtree, _LOCAL_ROOTS[context.applicationId], ignore_errors=True)
        root = _LOCAL_ROOTS[context.applicationId]
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the folders that its own thread made inside; results have to be written by then."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in made:
            delete(spark, path)


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a frame that later steps read several times to the shared folder, and reads it back."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_within(df: DataFrame, max_bytes: int) -> list[Row] | None:
    """The rows when their JSON takes at most `max_bytes`, else None; measured before any row reaches the driver."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()["size"] or 0
    return df.collect() if size <= max_bytes else None
