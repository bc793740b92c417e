"""Stages of a batch: timing, manifest, progress, catalogue of data sets, and the flow of a recipe."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Any
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.labels import human_label
from siftline.operators.sampling import hash_sample
from siftline.sources.readers import atomic_text, read_toml


@dataclass
class StageResult:
    name: str
    rows_in: int = 0
    rows_out: int = 0
    seconds: float = 0.0
    outputs: list[str] = field(default_factory=list)

    @property
    def retention(self) -> float:
        """Per cent of rows kept; 0 for an empty input."""
        return round(self.rows_out / self.rows_in * 100, 1) if self.rows_in else 0.0


def run_stage(name: str, work: Callable[[], StageResult], log: Callable[[str], None] = print) -> StageResult:
    """Runs a stage with its time; the stage's own name stays if it set one; errors are logged and raised."""
    began = time.monotonic()
    try:
        result = work()
    except Exception as e:
        log(f"{name} failed after {time.monotonic() - began:.1f} s: {e}")
        raise
    result.name, result.seconds = result.name or name, time.monotonic() - began
    log(f"{result.name}: {result.rows_in} -> {result.rows_out} rows ({result.retention} %), {result.seconds:.1f} s")
    return result


def deep_merge(old: Mapping[str, Any], new: Mapping[str, Any]) -> dict[str, Any]:
    """New values win; nested mappings are merged."""
    out = dict(old)
    for k, v in new.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


class Manifest:
    """The JSON record of a batch: category, source, batch, input, and its stages' paths, counts and provenance."""

    def __init__(self, path: str):
        self.path = path
        self.data: dict[str, Any] = json.loads(Path(path).read_text("utf-8")) if os.path.exists(path) else {}

    def init(self, fresh: bool = False, **head: Any) -> Manifest:
        """Sets the head; keeps what is there unless fresh."""
        self.data = deep_merge({} if fresh else self.data, {**head, "stages": {}})
        self._save()
        return self

    @staticmethod
    def for_folder(folder: str) -> Manifest:
        """The manifest of `<category>/<source>_<batch>`, made from the folder's name where there is none."""
        m = Manifest(os.path.join(folder, "manifest.json"))
        if not m.data:
            source, _, batch = Path(folder).name.rpartition("_")
            m.init(category=Path(folder).parent.name, source=source, batch=batch)
        return m

    def update_stage(self, name: str, **values: Any) -> None:
        self.data = deep_merge(self.data, {"stages": {name: values}})
        self._save()

    def _save(self) -> None:
        atomic_text(self.path, json.dumps(self.data, ensure_ascii=False, indent=2))


def sha256_of(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of each file of a folder, computed where the files are read.

    Files on a mounted file system are read a megabyte at a time; from other stores a file is one row, of 2 GB at most.
    """
    files = spark.read.format("binaryFile").load(path)
    if "://" in path.replace("file://", ""):
        return files.select("path", "length", F.sha2("content", 256).alias("sha256"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p in b["path"]:
                h = hashlib.sha256()
                with open(unquote(urlparse(p).path), "rb") as f:
                    while part := f.read(1 << 20):
                        h.update(part)
                out.append(h.hexdigest())
            yield b.assign(sha256=out)

    return files.select("path", "length").mapInPandas(digest, "path string, length long, sha256 string")


def ingest_verdicts(labels: DataFrame, verdict: str, key: str = "video_id", keep: Sequence[str] = ("title", "channel")) -> dict[str, DataFrame]:
    """Tables of a round of human checks: labeled, pass, fail, train_export and reject_validated.

    labeled has human_label (pass or fail) and y; other verdicts are left out. train_export has the key, y and the fields of `keep`
    that exist, one row per key, a fail before a pass; reject_validated the failed keys, with reject_action = confirm.
    """
    labeled = labels.withColumn("human_label", human_label(verdict)).where("human_label is not null").withColumn("y", (F.col("human_label") == "pass").cast("int"))
    have = [c for c in keep if c in labels.columns and c != key]
    train = labeled.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("y", *have)).alias("r")).select(key, "r.y", *(F.col(f"r.{c}").alias(c) for c in have))
    fail = labeled.where("human_label = 'fail'")
    return {"labeled": labeled, "pass": labeled.where("human_label = 'pass'"), "fail": fail, "train_export": train, "reject_validated": fail.select(key).distinct().withColumn("reject_action", F.lit("confirm"))}


def reflux_sample(dropped: DataFrame, n: int, seed: int | str, key: str = "video_id") -> DataFrame:
    """n dropped rows to be checked again, one per key, the same for the same seed; all of them if there are fewer."""
    one = dropped.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*[c for c in dropped.columns if c != key])).alias("r")).select(key, "r.*") if len(dropped.columns) > 1 else dropped.distinct()
    return hash_sample(one, n, seed, key)


def write_progress(path: str, done: int, total: int, passed: int = 0, **more: Any) -> dict[str, Any]:
    """A progress snapshot with overall and pass shares."""
    snap = {"done": done, "total": total, "pct": round(done * 100 / total, 1) if total else 0.0, "pass_pct": round(passed * 100 / done, 1) if done else 0.0, "updated_at": time.time(), **more}
    atomic_text(path, json.dumps(snap, ensure_ascii=False))
    return snap


def append_log(path: str, result: StageResult) -> None:
    with open(path, "a", encoding="utf-8") as f:
        f.write(f"- {time.strftime('%Y-%m-%d %H:%M:%S')} {json.dumps(asdict(result), ensure_ascii=False)}\n")


@dataclass(frozen=True)
class DatasetConfig:
    category: str
    options: Mapping[str, Any]


def load_catalogue(path: str) -> dict[str, DatasetConfig]:
    """Data sets by category from a TOML file of [[datasets]]; later entries win; an absent file is an empty catalogue."""
    if not os.path.exists(path):
        return {}
    return {d["category"]: DatasetConfig(d["category"], d) for d in read_toml(path).get("datasets", [])}


@dataclass(frozen=True)
class Recipe:
    """The ordered stages of a category, and those that run only when asked for by name."""

    stages: Sequence[str]
    on_request: Sequence[str] = ()

    def next_stage(self, manifest: Manifest) -> str | None:
        done = manifest.data.get("stages", {})
        return next((s for s in self.stages if s not in done and s not in self.on_request), None)

    def checklist(self, manifest: Manifest) -> list[tuple[str, bool]]:
        done = manifest.data.get("stages", {})
        return [(s, s in done) for s in self.stages]

    def run(self, manifest: Manifest, work: Mapping[str, Callable[[], StageResult]], upto: str | None = None, requested: Sequence[str] = ()) -> list[StageResult]:
        """Runs what is not done yet, in order, up to and with a stage; ValueError for an unknown stage."""
        if upto is not None and upto not in self.stages:
            raise ValueError(f"unknown stage {upto}")
        out = []
        for s in self.stages:
            if s not in manifest.data.get("stages", {}) and (s not in self.on_request or s in requested):
                r = run_stage(s, work[s])
                manifest.update_stage(s, rows_in=r.rows_in, rows_out=r.rows_out, seconds=r.seconds, outputs=r.outputs)
                out.append(r)
            if s == upto:
                break
        return out


def ids_key(ids: Sequence[str]) -> str:
    """A key of a set of ids for resuming: the digest of the sorted list."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


class Registry:
    """Named plug-ins: scorers, cleaners, encoders."""

    def __init__(self) -> None:
        self._items: dict[str, Callable[..., Any]] = {}

    def register(self, name: str) -> Callable[[Callable[..., Any]], Callable[..., Any]]:
        def add(f: Callable[..., Any]) -> Callable[..., Any]:
            if name in self._items:
                raise ValueError(f"{name} is registered already")
            self._items[name] = f
            return f

        return add

    def get(self, name: str) -> Callable[..., Any]:
        if name not in self._items:
            raise KeyError(f"{name} is not registered; known: {', '.join(sorted(self._items)) or 'none'}")
        return self._items[name]
