"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


#: Where ``cut`` notes its tables: nowhere outside a ``scratch``.
_SCRATCH: ContextVar = ContextVar("scratch", default=deque(maxlen=0))


def build_session(app: str = "offerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a laptop) a local folder is made; a cluster run never
    falls back to a machine-local path because its setting is always read first.
    """
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="offerloom-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(own)
    return own


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_file(spark: SparkSession, path: str, most: int) -> bytes:
    """The bytes of a file of any file system Spark reads, refused beyond ``most``."""
    p, fs = _hadoop_path(spark, path)
    size = fs.getFileStatus(p).getLen()
    if size > most:
        raise ValueError(f"{path} has {size} bytes; at most {most} are taken")
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage and plan start anew.

    A written table survives the loss of any executor, and unlike a checkpointed plan it does not
    carry the constraints of all earlier rounds, whose number doubles with each. The files go when
    the driver ends, or earlier with ``release`` or at the end of a ``scratch``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/offerloom-{uuid.uuid4().hex}"
    p, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(p)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._offerloom_path = path
    _SCRATCH.get().append(back)
    return back


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``cut`` writes inside are deleted at the end, so write or collect results inside."""
    tables: list[DataFrame] = []
    token = _SCRATCH.set(tables)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for t in tables:
            release(t)


def release(df: DataFrame) -> None:
    """Delete the files of a table written by ``cut`` that nothing will read again."""
    path = getattr(df, "_offerloom_path", None)
    if path:
        p, fs = _hadoop_path(df.sparkSession, path)
        fs.delete(p, True)
