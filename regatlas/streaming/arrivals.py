"""Block streams as they arrive: each file's blocks once, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..profile import Profile
from ..operators.extract import COLLECTIONS, build_kb
from ..sources.files import _blocks


def arriving_blocks(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the blocks of new ``*_content_list.json`` files below ``path``; a file is one document and complete."""
    return _blocks(spark.readStream.option("pathGlobFilter", "*_content_list.json").option("recursiveFileLookup", True).option("wholetext", True).text(path))


def append_kb(blocks: DataFrame, path: str, checkpoint: str, profile: Profile = Profile()) -> StreamingQuery:
    """Extract each micro-batch's documents and append them to the knowledge tables under ``path``.

    Extraction needs nothing beyond a document, so a batch is extracted like any set of files. A batch writes to its own
    partition, so that one repeated after a failure replaces itself.
    """

    def one(batch: DataFrame, number: int) -> None:
        for name, rows in build_kb(batch, profile, COLLECTIONS).items():
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    return blocks.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
