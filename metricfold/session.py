"""Session construction and the shared scratch location.

On a cluster the caller owns the session; :func:`build_session` is a helper for
local runs, tests and the benchmark.  Scratch data (state stores created by the
demo queries, CSV exports) always lives below the folder the session names in
``spark.checkpoint.dir`` so that every executor can reach it.  Only when that
setting is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed ones; the shuffle partition count is
# an upper bound AQE shrinks from.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 256 << 20,
                           minimum: int = 8) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``.

    One partition per ``partition_bytes`` of input keeps every reducer's share
    within executor memory even before AQE merges small partitions (it only ever
    coalesces, never splits, apart from skew handling).  100 TB gives ~400,000;
    AQE then coalesces toward the advisory size.
    """
    wanted = -(-int(input_bytes) // partition_bytes)
    return max(minimum, wanted)


def build_session(
    master: str | None = None,
    app_name: str = "metricfold",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    expected_input_bytes: int | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is None and expected_input_bytes:
        shuffle_partitions = shuffle_partitions_for(expected_input_bytes)
        conf["spark.sql.files.maxPartitionBytes"] = "256m"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    If a local session has none (tests), create a fresh one and register it,
    so ``DataFrame.checkpoint()`` and our scratch tables agree on a location.  On a
    cluster the setting is required: executors could not reach a folder of the driver.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = None
    try:
        context = spark.sparkContext
    except Exception:       # sessions without a local SparkContext handle
        context = None
    if not configured and context is not None:
        configured = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        master = context.master if context is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="metricfold-ckpt-")
        if context is not None:
            context.setCheckpointDir(configured)
        else:
            spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    root = checkpoint_root(spark)
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    if "://" in root:
        return f"{root}/metricfold/{name}"
    path = os.path.join(root, "metricfold", name)
    return path
