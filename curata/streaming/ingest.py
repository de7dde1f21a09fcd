"""Submission lines as a stream: each micro-batch is parsed, valid and rejected rows appended."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from curata.operators import reject


def ingest(lines: DataFrame, records_path: str, rejects_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start a stream of submission lines into Parquet tables of records and rejects.

    ``lines`` is a streaming table of line_id, chunk_file, line_no and raw_line. Headers are kept
    in a table beside the records, so a file's lines may come in any batch from its header's on;
    lines that come before it are rejected as without header. Blank lines are left out. A batch that is repeated after a
    failure replaces its own folders, so no row is written twice.
    """
    headers_path = f"{records_path.rstrip('/')}_headers"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.select("line_id", "chunk_file", "line_no", "raw_line").where("trim(raw_line) <> ''")
        own.where("line_no = 1").write.mode("overwrite").parquet(f"{headers_path}/batch={number}")
        known = spark.read.schema(own.schema).parquet(headers_path)
        here = own.select("chunk_file").distinct()
        given = own.where("line_no <> 1 or line_no is null").unionByName(known.join(here, "chunk_file", "left_semi").select(*own.columns))
        reject.typed_records(given).write.mode("overwrite").parquet(f"{records_path}/batch={number}")
        reject.rejected_lines(given).write.mode("overwrite").parquet(f"{rejects_path}/batch={number}")

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
