"""Sizes looked at while a plan is built: what may be broadcast, and how wide a scan is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Most bytes of query vectors sent to every executor at a time; more queries are worked off in blocks of that size.
QUERY_BROADCAST_BYTES = 8 * 1024 * 1024
#: Most bytes of search results, or of ids, sent to every executor; larger ones are joined by shuffling.
RESULT_BROADCAST_BYTES = 64 * 1024 * 1024
#: Least bytes of input per task when few splits are dealt out to many cores.
SPREAD_BYTES = 1024 * 1024
#: Most ids written into a plan as literals.
LITERAL_IDS = 1_000
#: Rows of per-task winners one task may merge; more of them are merged in two steps.
MERGE_ROWS = 1_000_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own estimate of the size of a result; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def split_bytes(spark: SparkSession) -> int:
    return max(1, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m").lower()))


def scan_tasks(df: DataFrame) -> int:
    """About how many tasks read a result, from the estimate and the split size."""
    return max(1, estimated_bytes(df) // split_bytes(df.sparkSession))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out to idle cores before work that is heavy per row, where the scan has few tasks for many cores.

    Only an input of few splits is ever shuffled by this; one with a task for every fourth core stays as it is.
    """
    size = estimated_bytes(df)
    tasks = max(1, size // split_bytes(df.sparkSession))
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, size // SPREAD_BYTES)
    return df.repartition(wanted) if wanted >= 4 * tasks else df


def winner_tasks(spark: SparkSession, tasks: int, winner_bytes: int) -> int:
    """How many tasks should look for winners: each reads at least ten times what it sends on, but none idles."""
    return min(tasks, max(4 * spark.sparkContext.defaultParallelism, tasks * split_bytes(spark) // (10 * winner_bytes)))


def _bytes(text: str) -> int:
    units = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    number = text.strip().rstrip("b")
    if number and number[-1] in units:
        return int(float(number[:-1]) * units[number[-1]])
    return int(number or 0)
