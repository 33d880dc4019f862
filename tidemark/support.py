"""Driver-side helpers: retries, timers, profiles, caches, run metrics, loggers."""

from __future__ import annotations

import functools
import json
import logging
import logging.config
import os
import random
import resource
import time
from collections import OrderedDict
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field


class MaxRetriesExceeded(Exception):
    """The last attempt failed too; the failure is its cause."""


@dataclass(frozen=True)
class RetryConfig:
    """How often, after what pauses and on which failures a call is made again."""

    exceptions: tuple[type[BaseException], ...] = (Exception,)
    max_attempts: int = 3
    delay: float = 1.0
    backoff: float = 2.0
    jitter: float = 0.0

    def __post_init__(self) -> None:
        if self.max_attempts < 1 or self.delay < 0:
            raise ValueError("at least one attempt, and no negative delay")

    def pauses(self):
        """Seconds before each further attempt."""
        for n in range(self.max_attempts - 1):
            yield self.delay * self.backoff**n + (random.uniform(0, self.jitter) if self.jitter > 0 else 0.0)

    def as_decorator(self) -> Callable:
        def wrap(f):
            @functools.wraps(f)
            def call(*args, **kwargs):
                pauses = self.pauses()
                while True:
                    try:
                        return f(*args, **kwargs)
                    except self.exceptions as e:
                        pause = next(pauses, None)
                        if pause is None:
                            raise MaxRetriesExceeded(f"{f.__name__}: {self.max_attempts} attempts failed, the last with {e!r}") from e
                        time.sleep(pause)

            return call

        return wrap


def retry(exceptions: tuple[type[BaseException], ...] = (Exception,), **how) -> Callable:
    return RetryConfig(exceptions, **how).as_decorator()


@contextmanager
def timed(results: dict | None = None, name: str = "elapsed_sec"):
    """Adds the block's wall seconds to ``results[name]``; gives the dict."""
    results = {} if results is None else results
    start = time.perf_counter()
    try:
        yield results
    finally:
        results[name] = results.get(name, 0.0) + time.perf_counter() - start


class Profile:
    """A callable with the number, sum and extremes of its calls' wall seconds."""

    def __init__(self, f: Callable):
        functools.update_wrapper(self, f)
        self.f = f
        self.reset()

    def reset(self) -> None:
        self.seen: list[float] = [0, 0.0, float("inf"), 0.0]

    def __call__(self, *args, **kwargs):
        took: dict = {}
        try:
            with timed(took, "s"):
                return self.f(*args, **kwargs)
        finally:
            n, total, low, high = self.seen
            self.seen = [n + 1, total + took["s"], min(low, took["s"]), max(high, took["s"])]

    @property
    def stats(self) -> dict[str, float]:
        n, total, low, high = self.seen
        return {"calls": n, "total_sec": round(total, 6), "avg_sec": round(total / n, 6) if n else 0.0, "min_sec": round(low, 6) if n else 0.0, "max_sec": round(high, 6)}


def memory() -> dict[str, float]:
    """Megabytes the driver's Python holds and has held at most."""
    with open("/proc/self/statm") as f:
        now = int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / (1 << 20)
    return {"current_mb": round(now, 4), "peak_mb": round(max(now, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024), 4)}


class LruCache:
    """A callable whose results are kept, the least recently used dropped first, with counts of hits, misses and evictions."""

    def __init__(self, f: Callable, size: int | None = 128):
        functools.update_wrapper(self, f)
        self.f, self.size, self.held = f, size, OrderedDict()
        self.hits = self.misses = self.evictions = 0

    def __call__(self, *args, **kwargs):
        key = (args, tuple(sorted(kwargs.items())))
        if key in self.held:
            self.hits += 1
            self.held.move_to_end(key)
            return self.held[key]
        self.misses += 1
        value = self.f(*args, **kwargs)
        self.held[key] = value
        if self.size is not None and len(self.held) > self.size:
            self.held.popitem(last=False)
            self.evictions += 1
        return value

    @property
    def stats(self) -> dict[str, float]:
        asked = self.hits + self.misses
        return {"hits": self.hits, "misses": self.misses, "evictions": self.evictions, "hit_rate": self.hits / asked if asked else 0.0}

    def clear(self) -> None:
        self.held.clear()
        self.hits = self.misses = self.evictions = 0


def cached(size: int | None = 128) -> Callable:
    return lambda f: LruCache(f, size)


class ExpiringCache:
    """At most ``size`` values, each for ``seconds``; the oldest goes first."""

    def __init__(self, size: int = 128, seconds: float = 60.0):
        self.size, self.seconds, self._held = size, seconds, OrderedDict()

    def get(self, key, default=None):
        at, value = self._held.get(key, (None, default))
        if at is not None and time.monotonic() - at > self.seconds:
            del self._held[key]
            return default
        return value

    def put(self, key, value) -> None:
        self._held.pop(key, None)
        self._held[key] = (time.monotonic(), value)
        while len(self._held) > self.size:
            self._held.popitem(last=False)


@dataclass
class RunMetrics:
    """What a run read, wrote and took."""

    pipeline_name: str
    input_records: int = 0
    output_records: int = 0
    elapsed_sec: float = 0.0
    input_mb: float = 0.0
    validation: dict = field(default_factory=dict)

    def to_dict(self) -> dict:
        """With throughput per second and the share of records dropped, neither ever negative."""

        def per_second(n: float) -> float:
            return n / self.elapsed_sec if self.elapsed_sec > 0 else 0.0

        lost = max(0, self.input_records - self.output_records) / self.input_records if self.input_records else 0.0
        extra = {"throughput_records_per_sec": round(per_second(self.output_records), 1), "mb_per_sec": round(per_second(self.input_mb), 3), "drop_rate": round(lost, 4)}
        return asdict(self) | {"elapsed_sec": round(self.elapsed_sec, 4)} | extra


def ensure_dir(path: str) -> str:
    os.makedirs(path, exist_ok=True)
    return path


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"level": record.levelname, "logger": record.name, "message": record.getMessage()})


def logger(name: str, as_json: bool = False, level: int = logging.INFO) -> logging.Logger:
    """A logger to standard error, one line a record, plain or as JSON."""
    plain = {"format": "%(asctime)s %(levelname)s %(name)s %(message)s"}
    logging.config.dictConfig({
        "version": 1, "incremental": False, "disable_existing_loggers": False,
        "formatters": {"line": {"()": JsonFormatter} if as_json else plain},
        "handlers": {name: {"class": "logging.StreamHandler", "formatter": "line"}},
        "loggers": {name: {"level": level, "handlers": [name]}},
    })
    return logging.getLogger(name)
