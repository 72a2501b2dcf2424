"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from ledgerloom.bounds import MAX_BATCHES_PER_RUN

# Largest "first rows per group" limit used here: one full run of packets.
_GROUP_LIMIT = MAX_BATCHES_PER_RUN * 200


def configure(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on for good plans; results do not depend on them."""
    # Push "first n rows per day" below the shuffle also for a whole run of packets.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(_GROUP_LIMIT))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def work_folder(spark: SparkSession) -> str:
    """New folder under the cluster's shared checkpoint folder.

    A machine-local folder is used only by a local session with none set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/ledgerloom-{uuid.uuid4().hex}"
