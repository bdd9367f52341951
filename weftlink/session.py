"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the engine is tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weftlink")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the cluster's `spark.checkpoint.dir`. Only a local session may leave it unset; it gets a temporary one."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="weftlink-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def tidy(spark: SparkSession) -> None:
    """Delete the shuffle files of a query when it ends. Stages hand their rows on in checkpoints, so nothing reads those files again.

    No stage may outlive its query then. Adaptive execution drops what an empty relation makes needless and ends the query while
    the dropped stages still run. Tasks of such a stage were seen to hang and to hold all cores of a cluster, probably because their
    shuffle files had gone. So that rule is off: every stage that was begun is ended first."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    key, rule = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    others = spark.conf.get(key, None) or ""
    if rule not in others:
        spark.conf.set(key, f"{others},{rule}".lstrip(","))


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: materialise `df` in the shared checkpoint folder, so that a lost executor costs no recomputation.

    A checkpointed plan keeps the size estimates of the plan it came from. In iterations with joins those are multiplied
    again and again, into numbers that take the planner minutes, so the rows are wrapped anew, without estimates; adaptive
    execution sees the real sizes."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tidy(spark)
    done = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False), spark)


def cut_by(df: DataFrame, column: str) -> DataFrame:
    """`df` dealt by a column and materialised like `cut`, but its rows stay known to lie by that column: joins on it move only the other side."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    tidy(spark)
    key = "spark.sql.adaptive.enabled"  # an adaptive plan does not tell how its rows lie
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), column).checkpoint(eager=True)
    finally:
        spark.conf.set(key, before)


def discard(*frames: DataFrame) -> None:
    """Delete the checkpoints of frames that `cut` made and nothing will read again."""
    for df in frames:
        plan = df._jdf.queryExecution().logical()
        rdd = plan.rdd() if plan.getClass().getSimpleName() == "LogicalRDD" else None
        while rdd is not None and not rdd.getCheckpointFile().isDefined():
            above = rdd.dependencies()
            rdd = above.apply(0).rdd() if above.size() == 1 else None
        if rdd is not None:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile().get())
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most `rows` rows for what is planned and run inside; bounds a worker's memory where rows are wide."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python workers can import it wherever they run."""
    tidy(spark)
    sc = spark.sparkContext
    if getattr(sc, "_weftlink_shipped", False):
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="weftlink-")) / "weftlink_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    sc.addPyFile(str(archive))
    sc._weftlink_shipped = True
