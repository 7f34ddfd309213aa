"""Reporter fan-out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

Sink = Callable[[DataFrame, int], None]


def chain(sinks: Sequence[Sink]) -> Sink:
    """One sink that feeds all, in order, from a batch computed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def report_stream(reports: DataFrame, sinks: Sequence[Sink], checkpoint: str) -> DataStreamWriter:
    return reports.writeStream.foreachBatch(chain(sinks)).option("checkpointLocation", checkpoint)
