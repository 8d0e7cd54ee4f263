"""Session settings and shared work folders."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; cluster sizing stays with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # HotSpot interprets generated methods above 8,000 bytes for good; whole-stage code of long checks is longer.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Tables are written once and read a few times: smaller files for little time.
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    # A repeated key in a JSON object keeps its last value instead of failing the record.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once for each application.

    The driver serves the archive to its executors, wherever they run, so functions that run in
    tasks can be found there without an installed package.
    """
    app_id = spark.sparkContext.applicationId
    if app_id in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app_id)


def local_session(cores: int | str = 8, app: str = "lakepnl", **conf: str) -> SparkSession:
    """Session for tests and bench.py."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local-mode session without that setting gets a folder of its own; on
    a cluster a machine-local folder would not be visible to every executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[app_id]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the work root; nothing is created until something is written."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, confs: dict[str, object]) -> Iterator[None]:
    """Session settings for a while; then they are as they were."""
    before = {name: spark.conf.get(name, None) for name in confs}
    for name, value in confs.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Shuffle files of a write are deleted when its rows are written, not when the driver happens to collect garbage.
FREES_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and of known size to the planner."""
    path = new_folder(df.sparkSession, label)
    with settings(df.sparkSession, FREES_SHUFFLES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
