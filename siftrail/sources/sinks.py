"""What is written: log segments, label files, datasets, reports, summaries, result tables."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftrail.operators.annotations import in_report_order
from siftrail.operators.intervals import rows_inside, segment_name
from siftrail.sources import named_files


def log_segments(lines: DataFrame, segments: DataFrame) -> DataFrame:
    """(name, line_no, line): the lines of each numbered segment under its file's name."""
    rows = rows_inside(lines, segments, ["file"])
    stem, suffix = F.regexp_extract("file", r"([^/]*?)(\.[^./]*)?$", 1), F.regexp_extract("file", r"([^/]*?)(\.[^./]*)?$", 2)
    return rows.select(segment_name(stem, F.col("seg_idx"), suffix).alias("name"), "line_no", "line")


def write_named(files: DataFrame, folder: str) -> DataFrame:
    """Write each (name, content) row as the file of that name below ``folder``; contents are text or bytes. All files or none.

    This and the two below that list files give (path, length) of what they have written.
    """
    return named_files.save(files.select("name", "content"), folder)


def listed_log_segments(named: DataFrame, path: str) -> DataFrame:
    """A file for each segment, its lines in order, all files or none."""
    lines = named.repartition("name").sortWithinPartitions("name", "line_no")
    return named_files.save(lines.select("name", F.concat("line", F.lit("\n")).alias("content")), path)


def write_log_segments(named: DataFrame, path: str) -> int:
    """``listed_log_segments``; gives the number of files."""
    return listed_log_segments(named, path).count()


def segments_written(named: DataFrame, segments: DataFrame) -> DataFrame:
    """Each segment with whether it has any line."""
    return segments.join(named.select("name").distinct().withColumn("written", F.lit(True)), "name", "left").na.fill(False, ["written"])


def listed_label_files(files: DataFrame, path: str) -> DataFrame:
    """A text file for each (name, content) row, its whole content, all files or none."""
    return named_files.save(files.select(F.concat("name", F.lit(".txt")).alias("name"), "content"), path)


def write_label_files(files: DataFrame, path: str) -> int:
    """``listed_label_files``; gives the number of files."""
    return listed_label_files(files, path).count()


def dataset_description(names: dict[int, str], folder: str = ".") -> dict:
    return {"path": folder, "train": "images", "val": "images", "nc": len(names), "names": [names[k] for k in sorted(names)]}


def write_description(names: dict[int, str], path: str) -> None:
    Path(path).write_text(yaml.safe_dump(dataset_description(names), sort_keys=False), encoding="utf-8")


def zip_dataset(folder: str, archive: str, parts: tuple[str, ...] = ("data.yaml", "images", "labels")) -> int:
    """The parts of a dataset's folder stored, not packed, in one archive; gives the files' number."""
    root, n = Path(folder), 0
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_STORED) as z:
        for part in parts:
            base = root / part
            for p in sorted([base] if base.is_file() else base.rglob("*")):
                if p.is_file():
                    z.write(p, p.relative_to(root))
                    n += 1
    return n


def write_document(one_row: DataFrame, path: str) -> None:
    """A one-row report as indented JSON."""
    text = one_row.select(F.to_json(F.struct("*")).alias("j")).first()["j"]
    Path(path).write_text(json.dumps(json.loads(text), indent=2, ensure_ascii=False), encoding="utf-8")


def write_rows_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_rows_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def printed_report(report: DataFrame, totals: DataFrame) -> str:
    """The report for a console: totals, then each split's classes, as many lines as those two."""
    whole = {r["split"]: r for r in totals.collect()}
    out = [f"Images: {whole[None]['images']:,}", f"Objects: {whole[None]['objects']:,}", f"Empty: {whole[None]['empty_images']:,} ({whole[None]['empty_pct']:.1f}%)"]
    now = object()
    for r in in_report_order(report).collect():
        if r["split"] != now:
            now, t = r["split"], whole[r["split"]]
            out.append(f"{now}: {t['images']:,} images, {t['objects']:,} objects, {t['empty_images']:,} empty ({t['empty_pct']:.1f}%)")
        out.append(f"  {r['class_name']}: {r['instances']:,} ({r['instance_pct']:.1f}%), in {r['images_with_class']:,} images ({r['image_pct']:.1f}%), S/M/L {r['small']:,}/{r['medium']:,}/{r['large']:,}")
    return "\n".join(out)
