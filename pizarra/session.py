"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. AQE re-plans joins and coalesces small
# shuffle outputs at run time; the skew-join split keeps a hot key from
# landing in one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of tables no longer referenced are deleted by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # one task per core: numpy's BLAS inside Python tasks must not also
    # spawn a thread per core
    "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
    "spark.executorEnv.MKL_NUM_THREADS": "1",
}


def get_session(master: str | None = None, app: str = "pizarra", **conf) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only for local runs; on a cluster leave it ``None`` so the
    launcher's setting wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors (``addPyFile`` of a zip), once per
    application, so Python tasks can import the helpers they call."""
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.join("pizarra", os.path.relpath(full, root)))
    # a fresh private folder: nobody else can have put a file there
    path = os.path.join(tempfile.mkdtemp(prefix="pizarra-code-"), "pizarra-code.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, whose
    executors share the driver's disk, gets a temporary folder when nothing is
    configured; elsewhere that is an error, since executors would each write to
    a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pizarra-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables.

    Used to cut lineage with a written table and for file round trips;
    it lives wherever the cluster keeps checkpoints, never on a
    machine-local temp folder of its own.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pizarra-{name}-{os.urandom(6).hex()}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table made and written (or collected) in here go when that has ended, not when the
    driver's JVM happens to collect its garbage: a job of many steps would fill the disks before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, its shuffles freed: far smaller than a checkpoint, and it cuts the lineage too."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application wrote (their results must
    have been read by then); how many there were."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)
