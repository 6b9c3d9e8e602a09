"""Writing a stream batch by batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def drain(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write`` with its number, and start.

    Without ``every`` the query takes all that is there and ends. After a failure the same batch comes
    again with the same number, so ``write`` should replace what that number wrote before.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )
