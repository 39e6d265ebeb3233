"""Starting streams."""

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start a stream: on a fixed interval, or over all that is there and then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def run(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all that is there and wait for the end."""
    start(writer, checkpoint).awaitTermination()
