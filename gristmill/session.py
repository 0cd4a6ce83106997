"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build(app: str = "gristmill", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the operators are tested under."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .getOrCreate()
    )


def ready_for_python(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the checkpoint folder that is set; where neither is and the session is local, one
    of our own. On a cluster a folder of one machine would lose data, so there it is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="gristmill-checkpoint-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that lost executors don't matter."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_fresh(df: DataFrame) -> DataFrame:
    """cut() without size estimates. A checkpoint keeps its plan's estimate, and joins multiply estimates: in a loop of joins
    they get so many digits that planning takes longer than the work."""
    jdf, spark = cut(df)._jdf, df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(jdf.toJavaRDD(), jdf.schema()), spark)
