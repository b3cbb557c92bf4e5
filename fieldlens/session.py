"""Session helpers.

The library never hard-codes cluster paths; whatever the cluster configures
(master, shuffle partitions, checkpoint folder) is left as it is.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at every scale: AQE re-plans joins and coalesces /
# splits shuffle partitions from runtime statistics, so the plans below are
# written declaratively and left for Catalyst + AQE to place.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "fieldlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the library's defaults.

    ``master``: explicit value, else the one spark-submit configured, else
    ``local[*]``.  ``shuffle_partitions``: set only when given (local runs);
    on a cluster keep the cluster's value and let AQE coalesce / split."""
    from pyspark import SparkConf
    master = master or SparkConf().get("spark.master", None) or "local[*]"
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark



def materialised(df: DataFrame) -> DataFrame:
    """A frame that several parts of one report read, computed once: it goes
    to the folder named in ``spark.checkpoint.dir``, which all machines share,
    and survives lost executors.  A session without that setting gets a folder
    of its own only where everything runs in this process (tests)."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
            folder = tempfile.mkdtemp(prefix="fieldlens-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
