"""The receiving run of ``tidegate.operators.register``, driven by newly landed files instead of a schedule."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegate.meta import Meta
from tidegate.operators.register import receive

LISTING = "path string, modificationTime timestamp, length long, content binary"


def receive_available(
    spark: SparkSession,
    directory: str,
    checkpoint: str,
    batch_name: str,
    load_meta: Callable[[], Meta],
    append: Callable[[DataFrame], None],
    root: str = "/Files",
) -> StreamingQuery:
    """Register all files that landed since the last call, then stop.

    Spark remembers seen files under ``checkpoint``. A micro-batch that is run again finds its files in the registry already,
    so nothing is registered twice. ``load_meta`` reads the control tables anew and ``append`` adds the new registry rows.
    """
    files = (
        spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", "true").load(directory).select("path")
    )

    def register(listing: DataFrame, _: int) -> None:
        append(receive(load_meta(), listing, batch_name, datetime.now(), root))

    return files.writeStream.foreachBatch(register).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
