"""Row-local scans over files as they arrive; the plans are those of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenwright.operators import dedup, pii


def stream_documents(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def pii_stream(docs: DataFrame, location: list[str], text: str, categories: list[str] | None = None) -> DataFrame:
    """Validated hits of a stream of rows: stateless, so no watermark is needed."""
    return pii.validate(pii.hits(docs, location, text, categories))


def contamination_stream(docs: DataFrame, reference_bands: DataFrame, id: str, text, **shape) -> DataFrame:
    """Stream-static join of the bands of new rows with those of a reference set (columns band, hash, ref)."""
    ours = dedup.banded(docs, id, text, **shape)
    return ours.join(reference_bands, ["band", "hash"]).select("id", "ref")


def write_stream(found: DataFrame, path: str, checkpoint: str, once: bool = True):
    out = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
