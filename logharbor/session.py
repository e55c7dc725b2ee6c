"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Least rows of the slices that ordered work per key is cut into (see functions.blocks).
SLICE_ROWS_KEY = "spark.logharbor.sliceRows"
SLICE_ROWS_DEFAULT = 200_000
#: Rows of one join key that a single task may get; larger keys are spread (see functions.blocks).
MAX_GROUP_ROWS_KEY = "spark.logharbor.maxGroupRows"
MAX_GROUP_ROWS_DEFAULT = 5_000_000

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "logharbor", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the library's settings; `conf` uses underscores for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on to a session made elsewhere, and ship the package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    A driver that was started elsewhere has it on its own path only.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = pathlib.Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="logharbor-package-")  # the driver serves it to the executors from here
    archive = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def slice_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SLICE_ROWS_KEY, str(SLICE_ROWS_DEFAULT)))


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_GROUP_ROWS_KEY, str(MAX_GROUP_ROWS_DEFAULT)))


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own: there driver and
    executors are one process, so a temporary folder is shared by construction.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="logharbor-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(work_dir(spark), "logharbor", purpose, uuid.uuid4().hex)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame as written to the shared checkpoint folder, so that later uses do not compute it again."""
    folder = work_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint()


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and safe when executors are lost."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
