"""Lines of position logs: ``<ISO time>;<sentence>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftrail.functions.geo import degrees
from siftrail.functions.session import free_name

FIX = "$GPGGA"
ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?)(Z|[+-]\d{2}:?\d{2})?$"


def timestamp(text: Column) -> Column:
    """A time in extended ISO form with a point or comma before the fraction; null if unreadable.

    Digits beyond microseconds are cut off; without an offset the session's zone counts.
    """
    shaped = F.regexp_replace(F.regexp_replace(text, ",", "."), r"(\.\d{6})\d+", "$1")
    return F.when(text.rlike(ISO), shaped.try_cast("timestamp"))


def stripped(text: Column) -> Column:
    """Without the white space around it, of whatever kind."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def split_line(line: Column) -> tuple[Column, Column]:
    """The time and sentence of a line, parted at the first semicolon; null if there is none."""
    parts = F.split(stripped(line), ";", 2)
    has = F.size(parts) == 2
    return F.when(has, parts[0]), F.when(has, parts[1])


def once(df: DataFrame, value: Column, out: str) -> DataFrame:
    """``df`` with a value that is computed once a row.

    It passes through a generator of one row; a plain column is computed again in each filter and column that uses it.
    """
    own = free_name(df, "once")
    return df.select("*", value.alias(own)).select("*", F.explode(F.array(own)).alias(out)).drop(own)


def fix(fields: Column) -> Column:
    """struct(quality, lat, lon) of the fields of a fix sentence, seven or more; null of any other.

    Quality is 0 unless it is all digits; a missing or odd coordinate is null.
    """
    at = lambda i: F.get(fields, F.lit(i))
    quality = F.when(at(6).rlike("^[0-9]+$"), at(6).try_cast("int")).otherwise(0)
    read = F.struct(F.coalesce(quality, F.lit(0)).alias("quality"), degrees(at(2), at(3)).alias("lat"), degrees(at(4), at(5)).alias("lon"))
    return F.when((F.size(fields) >= 7) & at(0).startswith(FIX), read)


def with_fix(df: DataFrame, sentence: str, out: str = "fix") -> DataFrame:
    """``df`` with the fix of a sentence.

    It passes through a generator of one row, so that the sentence is cut once and filters on the
    fix do not read it again.
    """
    fixes = F.transform(F.array(F.split(sentence, ",")), fix)
    return df.select("*", F.explode(fixes).alias(out))


RECORDING = r"^(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})_video\.(mkv|mp4|avi)$"


def recording_prefix(name: Column) -> Column:
    """The time prefix of a recording's file name; null for any other name."""
    return F.nullif(F.regexp_extract(name, RECORDING, 1), F.lit(""))


def recording_time(name: Column, zone: str = "Europe/Berlin") -> Column:
    """When a recording began: its name read as local time of ``zone``; null for any other name."""
    return F.to_utc_timestamp(F.try_to_timestamp(recording_prefix(name), F.lit("yyyy-MM-dd_HH-mm-ss")), zone)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def plain_path(path: Column) -> Column:
    """A file's path as file listings give it: one slash after ``file:``, blanks as they are."""
    return F.replace(F.regexp_replace(path, "^file:/+", "file:/"), F.lit("%20"), F.lit(" "))
