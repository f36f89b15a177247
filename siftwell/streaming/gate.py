"""The row-wise gates as a stream, with a sink that takes each line once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftwell.functions.rules import answer_reason, reject_reason
from siftwell.functions.text import normalize_question
from siftwell.sources.sinks import LineLog, as_lines


def gated(turns: DataFrame) -> DataFrame:
    """Turns (question, answer, ...) with reason: '' for those that pass the question and answer rules. No state is held."""
    normal = turns.withColumn("normal question", normalize_question(F.col("question")))
    noise = reject_reason(F.col("normal question"))
    answer = F.coalesce(answer_reason(F.col("question"), F.col("answer")), F.lit(""))
    return normal.withColumn("reason", F.when(noise != "", noise).otherwise(answer)).drop("normal question")


def stream_gate(spark: SparkSession, source: str, schema: str, log_path: str, checkpoint: str, key: str | None = None, files_per_batch: int = 100) -> StreamingQuery:
    """Reads new JSON-lines files below source, gates their turns and adds those that pass to a LineLog.

    Lines that came before are known by their digests in the query's keyed state, so a batch reads nothing of the
    log; a batch that is run again after a failure writes its own folder anew. With key, a turn whose key came
    before is dropped, too. The log belongs to this query. Stops when all files are read.
    """
    turns = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    if key:
        turns = turns.dropDuplicates([key])
    lines = as_lines(gated(turns).where("reason = ''").drop("reason")).dropDuplicates(["digest"])
    log = LineLog(spark, log_path)
    return lines.writeStream.foreachBatch(lambda batch, n: log.put(n, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
