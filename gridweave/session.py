"""Session defaults and the folder that all executors share."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", app: str = "gridweave", **conf: str) -> SparkSession:
    """A local session with the settings the operators are tuned for; conf overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("GRIDWEAVE_DRIVER_MEMORY", "8g"),
    } | conf
    return SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session that names none (tests, a laptop) gets an own one, made and set here;
    on a cluster that is an error, as a folder of one machine is none that the executors share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    own = spark.conf.get("gridweave.shared.dir", None)
    if own is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="gridweave-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.conf.set("gridweave.shared.dir", own)
        spark.sparkContext.setCheckpointDir(own)
    return own


def work_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one. It goes when the driver's Python ends, or by clean()."""
    sc = spark.sparkContext
    path = f"{shared_dir(spark)}/gridweave/{sc.applicationId}"
    if sc.applicationId not in _working:
        _working.add(sc.applicationId)
        atexit.register(clean, spark)
    return path


_working: set[str] = set()


def clean(spark: SparkSession) -> None:
    """Remove what materialise() kept for this application; results that still read it are void."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gridweave/{sc.applicationId}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it from there: cuts the lineage, survives the loss of executors."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, label: str) -> DataFrame:
    """materialise() for a table that grows with the data: joins right above it sort both sides. Its compressed size may look small enough
    to broadcast, but what a broadcast builds from it passes the driver, and many of them at once fill it."""
    return materialise(df, label).hint("merge")


def kept_only(*labels: str) -> Callable[[DataFrame, str], DataFrame]:
    """kept() for steps of these labels; the others stay part of the plans that read them, and cost nothing where none does."""
    return lambda df, label: kept(df, label) if label in labels else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session's executors, once for each application, from the shared folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/package-{uuid.uuid4().hex}/gridweave.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) on workers that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
