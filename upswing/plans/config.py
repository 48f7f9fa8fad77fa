"""Session settings for running the jobs on a cluster.

The library itself sets nothing on the session; these are the settings a job
should start with, scaled to the input size.
"""

from __future__ import annotations

MB = 1 << 20


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` of activity Parquet.

    * Scan splits of 256 MB; the first shuffle (distinct plays) is about as
      large as the filtered input, so the initial shuffle partition count is
      sized from the input and AQE coalesces the later, much smaller stages
      towards ``target_partition_bytes``.
    * AQE skew handling stays on for the joins; the aggregations are already
      skew-safe (partial aggregation, distinct count shuffled by play id).
    * Broadcasts are decided by AQE from measured sizes, capped at 64 MB.
    * Graceful decommissioning migrates shuffle and cached blocks off an
      executor that is being taken away; ``spark.checkpoint.dir`` must name
      shared storage and is left to the cluster. Checkpoint files of a job are
      removed once nothing references them.
    """
    initial = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
