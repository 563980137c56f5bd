"""Session helpers: a tuned session for local work and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "ledgerline", memory: str = "8g") -> SparkSession:
    """Session for tests and the local benchmark; clusters bring their own."""
    cores = 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_ledgerline_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="ledgerline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors fetch it until then
    shutil.copytree(package, f"{folder}/src/ledgerline", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/ledgerline-package", "zip", f"{folder}/src"))
    context._ledgerline_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without ever picking a machine-local folder on a cluster.

    The folder the cluster names in ``spark.checkpoint.dir`` wins. Only a local master with
    nothing configured gets a temporary folder; any other master has to be configured.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder inside the shared checkpoint location."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared checkpoint folder.

    Cuts the lineage like a checkpoint and survives lost executors, but is columnar: branches
    read only the columns they need, and their sizes are known to the planner.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
