"""Shared plumbing: the shared folder, materialised tables, label folds."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_OWN_DIR: dict[str, str] = {}

#: Rows of a text column that one Arrow batch may carry to a Python worker.
ARROW_ROWS = 256


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package and keeps their batches small.

    A worker holds one batch at a time: at most ``ARROW_ROWS`` rows, unless the
    session has a number of its own, and what Spark allows of bytes.
    """
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), _ROOT) if x)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session on one machine may
    leave it unset; it then has a folder of its own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = "file://" + tempfile.mkdtemp(prefix="nasij-")
    return _OWN_DIR[app]


class Written:
    """A DataFrame that was written to the shared folder, and can be removed."""

    #: those that are still there
    held: list["Written"] = []

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/nasij/{tag}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        Written.held.append(self)

    def drop(self) -> None:
        if self in Written.held:
            Written.held.remove(self)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(*kept: Written, since: int = 0) -> None:
    """Removes the tables that were written from the ``since``-th on, but for
    those kept. Results are lazy: call it when what reads them is written."""
    for w in Written.held[since:]:
        if w not in kept:
            w.drop()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def label_sample(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """Up to ``per_class`` training labels of each class: (doc_id, y).

    Rows of the held-out fold, without an id or with a null label take no part;
    of conflicting labels the larger counts. The choice is by a hash of the id,
    so that it is spread and repeatable. At most 2 * per_class rows: it may be
    broadcast.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (fold(F.col("doc_id")) != 2))
        .groupBy(F.col("doc_id").alias("doc_id"))
        .agg(F.max(F.when(F.col(column) > 0, 1).otherwise(0)).alias("y"))
        .withColumn("_h", F.xxhash64("doc_id", F.lit(97)))
    )
    one = [rows.where(F.col("y") == y).orderBy("_h", "doc_id").limit(per_class).select("doc_id", "y") for y in (0, 1)]
    return one[0].unionByName(one[1])


def label_counts(labels: DataFrame, column: str) -> dict[int, int]:
    """Training labels of each class, over all rows."""
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (fold(F.col("doc_id")) != 2))
        .groupBy(F.when(F.col(column) > 0, 1).otherwise(0).alias("y"))
        .count()
        .collect()
    )
    return {0: 0, 1: 0} | {r["y"]: r["count"] for r in rows}


def logistic(x, y, w, ridge: float = 1e-3, steps: int = 60):
    """Weighted logistic regression by Newton's method; the bias comes last."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))]).astype(float)
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    w = np.asarray(w, float) / np.sum(w) * len(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        g = x.T @ (w * (p - y)) + penalty * beta
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta
