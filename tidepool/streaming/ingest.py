"""Restartable ingestion of a large corpus snapshot.

A web snapshot of hundreds of GB is processed as a file stream with
``trigger(availableNow=True)``: Spark splits the files into bounded
micro-batches, records progress in a checkpoint on shared storage, and a
restarted job resumes after the last committed batch instead of starting over.
The per-batch work is the stateless batch operators (tokens, dictionary
matches), so no watermark or state store is involved.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators import terms, text
from tidepool.session import ensure_checkpoint_dir
from tidepool.sources.io import CORPUS_SCHEMA


def read_corpus_stream(spark: SparkSession, source: str, max_files_per_trigger: int = 1000,
                       fmt: str = "json") -> DataFrame:
    """Streaming scan of ``{url, text}`` records (JSON lines or Parquet)."""
    reader = spark.readStream.schema(CORPUS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source) if fmt == "json" else reader.parquet(source)


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """A progress folder under the shared ``spark.checkpoint.dir``."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def ingest(spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame], sink: str,
           name: str, checkpoint: str | None = None, max_files_per_trigger: int = 1000,
           fmt: str = "json") -> StreamingQuery:
    """Run ``transform`` over every file of ``source`` once, appending Parquet to ``sink``."""
    stream = transform(read_corpus_stream(spark, source, max_files_per_trigger, fmt))
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", sink)
            .option("checkpointLocation", checkpoint or default_checkpoint(spark, name))
            .trigger(availableNow=True).queryName(name).start())


def ingest_term_hits(spark: SparkSession, source: str, dictionary: DataFrame, sink: str,
                     stop_words: Iterable[str] | None = None, name: str = "term_hits",
                     checkpoint: str | None = None, max_files_per_trigger: int = 1000,
                     fmt: str = "json") -> StreamingQuery:
    """Token rows of every page that match the dictionary: ``(url, term, ...)``.

    The dictionary is a static table joined to each micro-batch (broadcast
    after its size check), so tokens are never shuffled.
    """
    def per_batch(corpus: DataFrame) -> DataFrame:
        toks = text.unigrams(corpus, "text", keep=["url"], stop_words=stop_words, out="w")
        return terms.term_hits(toks, dictionary, token="w")

    return ingest(spark, source, per_batch, sink, name, checkpoint, max_files_per_trigger, fmt)
