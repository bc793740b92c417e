"""Readers and writers: all-string tables, many files with their names, nested JSON, TOML, vectors, pictures, reports."""

from __future__ import annotations

import json
import os
import tomllib
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder, from its first line, without a byte order mark."""
    first = spark.read.text(path).limit(1).collect()
    return pd.read_csv(pd.io.common.StringIO(first[0][0].lstrip("﻿")), nrows=0).columns.tolist() if first else []


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, names: Sequence[str] | None = None, line_breaks: bool = True) -> DataFrame:
    """All columns as strings; quotes may hold line breaks and doubled quotes; asked-for columns that exist, in that order.

    A file whose quotes may hold line breaks is one task; with line_breaks = False large files are split.
    """
    have = list(names or csv_header(spark, path))
    schema = StructType([StructField(c, StringType()) for c in have])
    df = spark.read.schema(schema).option("header", True).option("multiLine", line_breaks).option("escape", '"').option("enforceSchema", True).csv(path)
    return df.select(*[c for c in columns if c in have]) if columns is not None else df


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet, JSON or CSV by the ending of the path."""
    low = path.rstrip("/").lower()
    if low.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif low.endswith((".json", ".jsonl")):
        df = spark.read.option("multiLine", low.endswith(".json")).json(path)
    else:
        return read_csv(spark, path, columns)
    return df.select(*[c for c in columns if c in df.columns]) if columns is not None else df


def read_many(spark: SparkSession, paths: Sequence[str], tag: str = "source_name", missing: str = "skip") -> DataFrame:
    """Several tables, each row with its file's stem; absent columns are null.

    A path that does not exist is passed over, or raises FileNotFoundError with missing = "raise"; ValueError if none is left.
    """
    from siftline.operators.joins import union_tagged

    tables = []
    for p in paths:
        if "://" not in p and not os.path.exists(p):
            if missing == "raise":
                raise FileNotFoundError(p)
            continue
        tables.append((Path(p.rstrip("/")).stem, read_table(spark, p)))
    return union_tagged(tables, tag)


def read_tree(spark: SparkSession, root: str, pattern: str, schema: StructType | str, fmt: str = "csv") -> DataFrame:
    """All files below a folder whose name matches, with their path in `file`."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(fmt).load(root).withColumn("file", F.col("_metadata.file_path"))


def find_files(root: str, pattern: str) -> list[str]:
    """Sorted paths below a folder."""
    return sorted(str(p) for p in Path(root).rglob(pattern))


def row_skew(spark: SparkSession, path: str, loaded: int) -> int:
    """Lines of a CSV file, without the header, minus loaded rows: more than 0 where lines were joined or lost."""
    return max(0, spark.read.text(path).count() - 1) - loaded


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    lost = [c for c in columns if c not in df.columns]
    if lost:
        raise ValueError(f"missing required columns: {', '.join(lost)}")


def check_table(df: DataFrame, required: Sequence[str], unique: str | None = None) -> list[str]:
    """Issues of a table; those that forbid its use begin with HARD:."""
    issues = [f"HARD: missing column {c}" for c in required if c not in df.columns]
    if unique and unique in df.columns:
        bad = df.groupBy(unique).count().where(F.col("count") > 1).limit(1).count()
        if bad:
            issues.append(f"repeated {unique}")
        if not df.where(F.col(unique).isNull() | (F.trim(unique) == "")).isEmpty():
            issues.append(f"blank {unique}")
    return issues


def read_toml(path: str) -> dict[str, Any]:
    with open(path, "rb") as f:
        return tomllib.load(f)


def read_pictures(spark: SparkSession, root: str, suffixes: Sequence[str] = ("maxresdefault", "hqdefault", "mqdefault", "sddefault", "0"), least: int = 1500) -> DataFrame:
    """(video_id, path, length): the best picture of each video below a folder, named `<id>_<suffix>.jpg`.

    Earlier suffixes are better; files under `least` bytes are taken for placeholders. Contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.jpg").load(root).select("path", "length").where(F.col("length") >= least)
    name = F.regexp_extract("path", r"([^/]+)\.jpg$", 1)
    rank = F.array_position(F.array(*(F.lit(s) for s in suffixes)), F.regexp_extract(name, r"_([A-Za-z0-9]+)$", 1))
    d = files.withColumn("video_id", F.regexp_replace(name, r"_[A-Za-z0-9]+$", "")).withColumn("rank", rank).where("rank > 0")
    return d.groupBy("video_id").agg(F.min(F.struct("rank", "path", "length")).alias("r")).select("video_id", "r.path", "r.length")


def import_npy(spark: SparkSession, vectors: str, ids: Sequence[str]) -> DataFrame:
    """(row, video_id, embedding) of a dense matrix file, read by the executors in blocks through a memory map."""
    n, block = len(ids), 10_000
    starts = spark.createDataFrame([(i, list(ids[i : i + block])) for i in range(0, n, block)], "start long, ids array<string>")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        data = np.load(vectors, mmap_mode="r")
        for b in batches:
            for start, names in zip(b["start"], b["ids"], strict=True):
                part = np.asarray(data[start : start + len(names)], dtype=np.float32)
                yield pd.DataFrame({"row": range(start, start + len(names)), "video_id": list(names), "embedding": list(part)})

    return starts.mapInPandas(load, "row long, video_id string, embedding array<float>")


def export_npy(df: DataFrame, key: str, vector: str, path: str, half: bool = True) -> int:
    """Writes vectors as dense matrix files `part-<n>.npy` beside their ids `part-<n>.ids.json`, one pair a task; returns the rows.

    The folder must be mounted at the same path everywhere. Null vectors are left out; sizes must be equal.
    """
    os.makedirs(path, exist_ok=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        from pyspark import TaskContext

        got = [b for b in batches if len(b)]
        if got:
            t = pd.concat(got)
            stem = f"{path}/part-{TaskContext.get().partitionId():05d}"
            with open(f"{stem}.tmp", "wb") as f:
                np.save(f, np.stack(t["vector"].to_numpy()).astype(np.float16 if half else np.float32))
            os.replace(f"{stem}.tmp", f"{stem}.npy")
            atomic_text(f"{stem}.ids.json", json.dumps(t["id"].astype(str).tolist()))
            yield pd.DataFrame({"n": [len(t)]})

    parts = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("vector")).mapInPandas(write, "n long")
    return sum(r.n for r in parts.collect())  # a row per task


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """A folder of CSV parts; with bom = True one small file for people, with a byte order mark, by the driver."""
    if not bom:
        df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return
    atomic_text(path, df.toPandas().to_csv(index=False), "utf-8-sig")


def atomic_text(path: str, text: str, encoding: str = "utf-8") -> None:
    """Write beside the target, then replace it; a failed write leaves the target as it was."""
    tmp = f"{path}.tmp"
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(tmp, "w", encoding=encoding, newline="") as f:
        f.write(text)
    os.replace(tmp, path)


def write_report(report: Mapping[str, Any] | DataFrame, path: str) -> None:
    """A JSON report, from a mapping or from a table of few rows."""
    data = [r.asDict(recursive=True) for r in report.collect()] if isinstance(report, DataFrame) else dict(report)
    atomic_text(path, json.dumps(data, ensure_ascii=False, indent=2, default=str))


def markdown_table(df: DataFrame, title: str) -> str:
    """A small table as Markdown."""
    rows = df.collect()
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows), ""])
