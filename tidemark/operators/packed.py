"""Fields that hold several values: one row per value, with its position.

The tokenizer is a finite-state machine. Runs of ordinary characters are taken in one step by a compiled
pattern, so a state change costs one match rather than one character. States: START (before a value),
PLAIN (inside an unquoted value), QUOTED (inside quotes, where a doubled quote stands for one), CLOSED
(after the closing quote, until the next separator). Nesting depth counts square brackets outside quotes.

Fixed cases
* null, empty and blank fields, and fields of separators only, give no rows;
* empty pieces take no position, repeated values each count;
* a quote that is never closed is no quote: a lone ``'`` is part of the value, a lone ``"`` separates;
* text between a closing quote and the next separator belongs to the same value;
* an apostrophe inside a single-quoted value closes it only if a separator or the end follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import spread

# Characters that an unquoted value consists of, besides letters and digits.
VALUE_CHARS = " &/-'().:+"

_RUN = re.compile(r"(?:[^\W_]|[ &/\-'().:+])+")
_BLANKS = re.compile(r"\s+")


def _closing(text: str, at: int, quote: str) -> int:
    """Index of the quote that closes the one before ``at``; -1 if none does."""
    n = len(text)
    while True:
        at = text.find(quote, at)
        if at < 0:
            return -1
        if at + 1 < n and text[at + 1] == quote:
            at += 2
            continue
        if quote == "'":
            rest = at + 1
            while rest < n and text[rest] == " ":
                rest += 1
            if rest < n and _RUN.match(text[rest]):
                at += 1
                continue
        return at


def split_packed(text: str | None) -> list[str]:
    """The values of one field, in order."""
    if not text:
        return []
    out: list[str] = []
    parts: list[str] = []
    i, n, depth, start = 0, len(text), 0, True

    def flush() -> None:
        value = "".join(parts).strip()
        parts.clear()
        if value:
            out.append(value)

    while i < n:
        c = text[i]
        if start and (c == '"' or c == "'"):
            end = _closing(text, i + 1, c)
            if end >= 0:
                parts.append(text[i + 1 : end].replace(c + c, c))
                i, start = end + 1, False
                continue
        if start and c == " ":
            i += 1
            continue
        run = _RUN.match(text, i)
        if run:
            parts.append(run.group())
            i, start = run.end(), False
            continue
        if c == "[":
            depth += 1
        elif c == "]" and depth:
            depth -= 1
        flush()
        i, start = i + 1, True
    flush()
    return out


def _explode(batches: Iterable[pa.RecordBatch], ids: list[str], field: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index: list[int] = []
        pos: list[int] = []
        val: list[str] = []
        for row, text in enumerate(batch.column(batch.schema.get_field_index(field)).to_pylist()):
            values = split_packed(text)
            index.extend([row] * len(values))
            pos.extend(range(1, len(values) + 1))
            val.extend(values)
        take = pa.array(index, pa.int64())
        columns = [batch.column(batch.schema.get_field_index(c)).take(take) for c in ids]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(pos, pa.int64()), pa.array(val, pa.string())], [*ids, "pos", "val"])


def explode_packed(df: DataFrame, ids: list[str], field: str) -> DataFrame:
    """``ids``, ``pos`` (from 1) and ``val`` of every value in ``field``.

    A map-only operator (an input smaller than the cores is dealt out first); only ``ids`` and ``field`` are read. Other columns of
    ``df``, whatever their names, are left out.
    """
    narrow = df.select(*[F.col(f"`{c}`") for c in ids], F.col(f"`{field}`").cast("string").alias("__packed"))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ids), "pos bigint", "val string"])
    return spread(narrow.filter(F.length("__packed") > 0)).mapInArrow(lambda it: _explode(it, ids, "__packed"), schema)
