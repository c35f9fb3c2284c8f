"""Tables written to the shared checkpoint folder, used to cut lineage.

A written Parquet table survives the loss of any executor, is computed once (a
``DataFrame.checkpoint()`` computes its last stage twice) and keeps column
pruning for its readers. Operators delete tables that their result does not read; a result is lazy, so those
that it reads are deleted when the program ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlsplit

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    ``spark.checkpoint.dir`` of the session is used when it is set. Otherwise a local
    master (tests) gets a temporary folder and a cluster the warehouse folder.
    """
    found = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    master = context.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        own = getattr(context, "_bibweave_scratch", None)
        if own is None:
            own = tempfile.mkdtemp(prefix="bibweave-")
            context._bibweave_scratch = own
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        return "file://" + own
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


#: Rows of a small table that are worth a file of their own.
ROWS_A_FILE = 100_000


def materialize(df: DataFrame, name: str, compression: str = "snappy", rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it.

    ``rows`` is a bound of its rows, if known: a small table is then written by as few tasks as it needs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._bibweave_path = path
    at_end(spark, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the program ends; if the session was stopped by then, only one on a local disk."""
    held = getattr(spark.sparkContext, "_bibweave_made", None)
    if held is None:
        held = spark.sparkContext._bibweave_made = set()
        atexit.register(_delete_all, spark, held)
    held.add(path)


def _delete_all(spark: SparkSession, paths: set[str]) -> None:
    if spark.sparkContext._jsc is None:  # the session was stopped, and with it the way to any other store
        for path in paths:
            if path.startswith("file:"):
                shutil.rmtree(urlsplit(path).path, ignore_errors=True)
        return
    for path in paths:
        try:
            _delete(spark, path)
        except (Py4JError, OSError):  # the cluster is gone, or the folder is
            return


def discard(*frames: DataFrame | None) -> None:
    """Delete the files behind frames made by :func:`materialize`, and those they were made of; nothing may read them later."""
    for df in frames:
        for other in getattr(df, "_bibweave_parts", ()):
            discard(other)
        path = getattr(df, "_bibweave_path", None)
        if path is not None:
            _delete(df.sparkSession, path)
            df.sparkSession.sparkContext._bibweave_made.discard(path)
