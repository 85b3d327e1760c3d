"""The streaming form: documents arrive as files, results are appended to the audit log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: One row a document, with an array of its readings: no state is kept between rows.
SCHEMA = "doc_id long, readings array<struct<roi_id:string,text:string,score:decimal(9,4)>>"


def wide_rows(documents: DataFrame, roi_ids: list[str]) -> DataFrame:
    """Text tNN and score cNN of each region, straight from the array; no shuffle."""
    of = lambda r, k: F.get(F.filter("readings", lambda x: x["roi_id"] == r), F.lit(0))[k]
    return documents.select("doc_id", *[of(r, k).alias(f"{n}{r[1:]}") for r in roi_ids for k, n in (("text", "t"), ("score", "c"))])


def run(spark: SparkSession, source: str, log: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], day: str) -> StreamingQuery:
    """Reads what has arrived, appends the records under the day's folder, and stops; a rerun goes on from the checkpoint."""
    arrived = spark.readStream.schema(SCHEMA).parquet(source)
    out = transform(arrived).withColumn("log_date", F.lit(day))
    return out.writeStream.format("json").option("path", log).option("checkpointLocation", checkpoint).partitionBy("log_date").trigger(availableNow=True).outputMode("append").start()


class Progress(StreamingQueryListener):
    """Calls back with (batch, rows) after every batch."""

    def __init__(self, call: Callable[[int, int], None]):
        self.call = call

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.call(event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
