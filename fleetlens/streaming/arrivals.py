"""Raw tables kept up to date from a stream of file arrivals.

The stream carries which files arrived or were rewritten under their name, not their rows: the columns of counter files are only known
once they are there.  Each batch loads the weeks in which files arrived with the batch reader, so a
batch that is repeated after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.plans.layers import Job, load_counters, load_states  # noqa: F401
from fleetlens.streaming.file_changes import file_changes

def _arrived_weeks(batch: DataFrame) -> DataFrame:
    """(ww, rank) of the week folders in which files arrived, newest first; other folders don't count."""
    weeks = batch.select(F.regexp_extract("path", r"/([0-9]{4}WW[0-9]{2})/[^/]+$", 1).alias("ww")).distinct().where("ww <> ''")
    # Week labels sort by time; only their order matters, so the negated number serves as rank.
    return weeks.select("ww", (-F.replace("ww", F.lit("WW"), F.lit("")).cast("bigint")).alias("rank"))


def start(
    job: Job, pattern: str, load: Callable[[Job, DataFrame], object], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Watch ``source/*/pattern``; ``load`` is ``load_states`` or ``load_counters``.

    With ``available_now`` the query ends once all files that are there have been loaded.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        weeks = _arrived_weeks(batch)
        if not weeks.isEmpty():
            load(job, weeks)

    arrivals = file_changes(job.spark, job.source, pattern).select("path")
    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
