"""Calls to outside services inside a stage: retries, a shared gate that adapts, and error kinds. Clients are plugged in."""

from __future__ import annotations

import os
import random
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Parts of error texts that stand for a lasting or a passing failure.
PERMANENT = ("private video", "video unavailable", "removed", "not available", "404", "410", "copyright", "terminated")
TRANSIENT = ("429", "too many requests", "timed out", "timeout", "connection", "503", "502", "500", "temporarily")


def error_kind(text: str) -> str:
    """transient, permanent or unknown."""
    low = text.lower()
    if any(p in low for p in TRANSIENT):
        return "transient"
    return "permanent" if any(p in low for p in PERMANENT) else "unknown"


class AdaptiveGate:
    """Limits calls at a time: one less after a throttled call, one more after a quiet interval, one alone when tripped."""

    def __init__(self, most: int, recover_s: float = 30.0, clock: Callable[[], float] = time.monotonic):
        self.most, self.limit, self.recover_s, self.clock = most, most, recover_s, clock
        self._busy, self._cond, self._since = 0, threading.Condition(), clock()

    def __enter__(self) -> AdaptiveGate:
        with self._cond:
            self._recover()
            while self._busy >= self.limit:
                self._cond.wait(0.1)
                self._recover()
            self._busy += 1
        return self

    def __exit__(self, *_: object) -> None:
        with self._cond:
            self._busy -= 1
            self._cond.notify()

    def _recover(self) -> None:
        steps = int((self.clock() - self._since) / self.recover_s)
        if steps > 0 and self.limit < self.most:
            self.limit = min(self.most, self.limit + steps)
            self._since = self.clock()

    def throttled(self) -> None:
        with self._cond:
            self.limit = max(1, self.limit - 1)
            self._since = self.clock()

    def trip(self) -> None:
        with self._cond:
            self.limit = 1
            self._since = self.clock()


def with_retries(call: Callable[[], object], retries: int = 3, sleep: Callable[[float], None] = time.sleep, gate: AdaptiveGate | None = None) -> object:
    """Up to retries + 1 attempts; waits 2, 4, 8 … seconds and a random half before the next after a passing failure."""
    for attempt in range(retries + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            if attempt == retries or error_kind(str(e)) != "transient":
                raise
            if gate and "429" in str(e):
                gate.throttled()
            sleep(2 ** (attempt + 1) + random.uniform(0, 0.5))
    raise AssertionError


def fetch_cached(df: DataFrame, key: str, fetch: Callable[[str], bytes | None], cache: str, suffix: str = ".jpg", workers: int = 8, least: int = 1500) -> DataFrame:
    """(key, path, length, status): a file per key in a cache folder that all executors mount, fetched where it is missing.

    status is cached, fetched, small (under `least` bytes, taken for a placeholder and not kept) or the kind of error; path is null unless
    the file is there. A file is written beside its place and then renamed, so that a lost task leaves no half of one. Keys come out once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(cache, exist_ok=True)

        def one(k: str) -> tuple:
            path = os.path.join(cache, f"{k}{suffix}")
            if os.path.exists(path):
                return k, path, os.path.getsize(path), "cached"
            try:
                data = fetch(k)
            except Exception as e:  # noqa: BLE001
                return k, None, None, error_kind(str(e))
            if data is None or len(data) < least:
                return k, None, None if data is None else len(data), "small"
            with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
                f.write(data)
            os.replace(f.name, path)
            return k, path, len(data), "fetched"

        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                yield pd.DataFrame(list(pool.map(one, b["key"])), columns=[key, "path", "length", "status"]).astype({"length": "Int64"})

    names = df.select(F.col(key).cast("string").alias("key")).where("key is not null and key rlike '^[A-Za-z0-9_-]+$'").distinct()
    return names.mapInPandas(run, f"{key} string, path string, length long, status string")


def call_per_row(df: DataFrame, make_client: Callable[[], Callable[[dict], dict]], schema: StructType | str, workers: int = 4) -> DataFrame:
    """One call per row with a pool of threads per task; the client is built once per task.

    Filter before, because no filter moves below this step. A failed call gives a row of nulls but for `error`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def one(row: dict) -> dict:
            try:
                return {**row, **client(row), "error": None}
            except Exception as e:  # noqa: BLE001
                return {**row, "error": f"{error_kind(str(e))}: {e}"}

        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                yield pd.DataFrame(list(pool.map(one, b.to_dict("records"))), columns=names, dtype=object)

    names = [f.name for f in (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields]
    return df.mapInPandas(run, schema)
