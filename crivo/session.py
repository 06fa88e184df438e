"""Session settings and the shared working folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_base: str | None = None


def build_session(
    app_name: str = "crivo", master: str = "local[*]", conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the engine is tested under."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM does not compile methods beyond 8,000 bytes; a stage whose
        # generated method is larger runs faster operator by operator.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read and write.

    A cluster names it in ``spark.checkpoint.dir``. A local session without the
    setting gets a temporary folder; a cluster without it is an error, since a
    folder of one machine would be lost with that machine.
    """
    global _local_base
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    # A local-cluster has executors of its own, as a cluster does.
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="crivo-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
