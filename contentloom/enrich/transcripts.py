"""Transcript table from time-ordered segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from contentloom.functions.html import quoted_value


def with_segment_ids(segments: DataFrame, file: str = "file_id", start: str = "segment_start") -> DataFrame:
    """Number the segments of a file from 0 by their start time."""
    n = F.row_number().over(Window.partitionBy(file).orderBy(start)) - 1
    return segments.withColumn("segment_id", n)


def media_url(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``file_url``: the media address quoted in the page, '' where absent."""
    return pages.withColumn("file_url", quoted_value(html, "contentUrl"))


def transcripts(segments: DataFrame) -> DataFrame:
    """(source_url, download_url, transcription_json, fulltext, length_in_s, created_at) per
    file.

    Segments may arrive in any order. The full text of a file is one value of the result
    table, so one file's segments meet in one row.
    """
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                "segment_id", "file_id", "file_url", "text", "segment_start", "segment_end"
            )
        )
    )
    grouped = segments.groupBy(F.col("file_id").alias("source_url")).agg(
        ordered.alias("_segments"),
        F.min_by("file_url", "segment_id").alias("download_url"),
        F.ceil(F.max("segment_end")).cast("int").alias("length_in_s"),
    )
    return grouped.select(
        "source_url",
        "download_url",
        F.to_json("_segments").alias("transcription_json"),
        F.array_join(F.transform("_segments", lambda s: s["text"]), " ").alias("fulltext"),
        "length_in_s",
        F.current_timestamp().alias("created_at"),
    )
