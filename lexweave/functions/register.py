"""The domain's functions by name, for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lexweave.functions import align, kana, transcription


def register_all(spark: SparkSession, readings: align.Readings | None = None) -> list[str]:
    """Register modern_variants, transcriptions and, with a reading table, reading_fits and segment_reading."""
    own = {"modern_variants": kana.modern_variants, "transcriptions": transcription.transcription_forms}
    if readings is not None:
        own |= {"reading_fits": align.fits_udf(readings), "segment_reading": align.segment_udf(readings)}
    for name, f in own.items():
        spark.udf.register(name, f)
    return sorted(own)
