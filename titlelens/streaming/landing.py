"""The batch cleaning run as a stream over the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from titlelens.operators.merge import merge_landing
from titlelens.sources.records import RAW_SCHEMA


def clean_new_files(spark: SparkSession, raw_path: str, out_path: str, checkpoint_path: str,
                    schema: T.StructType = RAW_SCHEMA, multi_line: bool = True) -> StreamingQuery:
    """Take the files landed since the last run into the table at `out_path`, and stop.

    The checkpoint remembers the files done.  Each batch is merged into the buckets that its ids
    fall into (`merge`), and no other part of the table is read or written.  A batch that is run
    again changes nothing.  `merge.merged_titles` reads the table, which is the same as one
    cleaning of all files together, in whatever order they came.
    """
    landed = (spark.readStream.schema(schema).option("multiLine", multi_line)
              .option("pathGlobFilter", "*.json").json(raw_path))

    def merge(batch: DataFrame, _: int) -> None:
        merge_landing(batch, out_path)

    return (landed.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True).start())
