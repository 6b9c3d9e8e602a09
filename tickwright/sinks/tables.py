"""Writing rows to files, to a database or to the console."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def append_rows(df: DataFrame, path: str, by_day: str | None = None, fmt: str = "parquet") -> None:
    """Append rows; ``by_day`` names a date column to make one folder per day.

    Rows are gathered by day first, so that a day is a few files and not one per task. Adaptive
    execution splits a day that is too large for one task.
    """
    if by_day:
        df = df.hint("rebalance", by_day)
    writer = df.write.mode("append").format(fmt)
    if by_day:
        writer = writer.partitionBy(by_day)
    writer.save(path)


def jdbc_write_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    batchsize: int = 4_000,
    connections: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC append: rows go in batches, over at most ``connections`` at a time."""
    chosen = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": batchsize,
        "numPartitions": connections,
    }
    return {key: str(value) for key, value in chosen.items() if value is not None}


def write_jdbc(df: DataFrame, url: str, table: str, **kwargs) -> None:
    """Append rows to a database table, columns bound by name."""
    df.write.format("jdbc").mode("append").options(**jdbc_write_options(url, table, **kwargs)).save()


def write_new_version(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write changed rows as a whole new version, to a path other than the one they were read from."""
    df.write.mode("errorifexists").format(fmt).save(path)


def print_rows(df: DataFrame, rows: int = 20) -> None:
    """Show a sample: the first ``rows`` rows."""
    df.show(rows, truncate=False)


def print_stream(stream: DataFrame, checkpoint: str, rows: int = 20) -> StreamingQuery:
    """Show a sample of each micro-batch: its first ``rows`` rows. Use ``drain`` to handle all."""
    return (
        stream.writeStream.format("console")
        .option("checkpointLocation", checkpoint)
        .option("truncate", "false")
        .option("numRows", rows)
        .trigger(availableNow=True)
        .start()
    )
