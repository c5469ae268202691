"""O4 session settings and the shared scratch location.

The library never builds its own session on a cluster: callers pass one.
``session_conf`` lists the settings the pipeline is designed for.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session_conf(shuffle_partitions: int | None = None,
                 initial_partitions: int | None = None,
                 advisory_partition_bytes: int | None = None,
                 time_zone: str = "UTC") -> dict[str, str]:
    """Settings the pipeline is planned for.

    * AQE with partition coalescing and skew-join splitting: the only
      shuffles (X1, X2) are keyed by row hash or business key, and a hot key
      must be split, not sent to one task.
    * UTC session zone: the text of a ``TIMESTAMP`` column, and so the row
      hash, depends on the zone.
    * At 100 TB, start shuffles wide (``initial_partitions``, e.g. 20000) and
      let AQE coalesce them to ``advisory_partition_bytes`` (e.g. 256 MiB);
      scans keep the default 128 MiB splits.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": time_zone,
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions is not None:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    if advisory_partition_bytes is not None:
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(advisory_partition_bytes)
    return conf


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext (Connect)
        d = None
    return d or spark.conf.get("spark.checkpoint.dir", None)


def check_zone(spark: SparkSession, zone: str) -> None:
    """Row hashes of ``TIMESTAMP`` columns depend on the session's zone."""
    now = spark.conf.get("spark.sql.session.timeZone")
    if now not in {zone, *({"Etc/UTC", "UTC", "Z"} if zone == "UTC" else ())}:
        raise ValueError(f"spark.sql.session.timeZone is {now!r}, the run is configured for "
                         f"{zone!r}")


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh directory under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without one gets its own; on a cluster a folder of
    the driver's machine would be lost on every other, so that raises.
    """
    root = _checkpoint_dir(spark)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
            root = _checkpoint_dir(spark) or root
        except Exception:  # no SparkContext (Connect): use the directory as is
            pass
    base = root.rstrip("/")
    return "/".join([base, "tidewater", *parts, uuid.uuid4().hex])
