"""Frames of videos, decoded by a function that is passed in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftrail.functions import logs
from siftrail.functions.session import importable


def frames(spark: SparkSession, folder: str, decoder: Callable[[bytes], Iterable[tuple[float, Any]]], frame: str = "image binary", pattern: str = "*.mp4", batch_frames: int = 64) -> DataFrame:
    """(video, frame_idx, pos_ms, frame) of every frame of every video, from the first to the last.

    ``decoder(content)`` gives the place in milliseconds and the value of each frame in turn; ``frame``
    names and types the value. Frames are handed on ``batch_frames`` at a time, so a long video is
    never held decoded. A video that cannot be read further ends there; an empty one has no frames.
    """
    importable(spark)
    value = T._parse_datatype_string(frame).fields[0]
    schema = T.StructType([*T._parse_datatype_string("video string, frame_idx bigint, pos_ms double").fields, value])

    def run(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for video, content in zip(part["video"], part["content"], strict=True):
                held: list[tuple] = []
                for index, (at, image) in enumerate(decoder(bytes(content))):
                    held.append((video, index, float(at), image))
                    if len(held) == batch_frames:
                        yield pd.DataFrame(held, columns=schema.names)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=schema.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(logs.file_name(F.col("path")).alias("video"), "content").mapInPandas(run, schema)
