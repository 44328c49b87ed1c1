"""Session helpers: where lineage is cut, and a local session for tests."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that tests and benchmarks share."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("skylode")
    base = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that cut lineage is written to.

    It is the cluster's own ``spark.checkpoint.dir``. Only where that is unset and none was set on the context does a
    local session (a test) get a temporary folder, which is removed when Python ends; on a cluster, whose executors don't
    share one, that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "") or sc.getConf().get("spark.checkpoint.dir", "")
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="skylode-checkpoint-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        named = f"file://{made}"
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the checkpoint folder; its partitions stay fixed after that.

    Used where several jobs read the same rows, or where row positions inside partitions must not change
    when an executor is lost. The files go when the driver no longer holds the result (if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
