"""Digests of texts, records and files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def md5_hex(c: Column) -> Column:
    return F.md5(c.cast("string"))


def record_fingerprint(df: DataFrame, fields: Sequence[str] | None = None, algorithm: str = "sha256") -> Column:
    """Digest of a record that doesn't depend on the order of its columns; a missing field counts as null. Values of
    different types differ (``1``, ``1.0``, ``true`` and ``"1"``)."""
    if algorithm not in ("sha256", "md5"):
        raise ValueError(f"unknown algorithm {algorithm!r}")
    names = sorted(fields if fields is not None else df.columns)
    there = set(df.columns)
    parts = [(F.col(f"`{n}`") if n in there else F.lit(None).cast("string")).alias(n) for n in names]
    text = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    return F.sha2(text, 256) if algorithm == "sha256" else F.md5(text)


def short_id(df: DataFrame, fields: Sequence[str] | None = None, length: int = 8) -> Column:
    if not 1 <= length <= 64:
        raise ValueError("length must be from 1 to 64")
    return F.substring(record_fingerprint(df, fields), 1, length)


def file_digests(spark: SparkSession, path: str, block: int = 1 << 20) -> DataFrame:
    """(path, sha256) of each file's content. Only names are listed by Spark; a file of any size is read in blocks, one task
    per file."""
    names = spark.read.format("binaryFile").load(path).select("path")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                local = uri.startswith("file:")
                where = None if local else pa_fs.FileSystem.from_uri(uri)
                h = hashlib.sha256()
                with open(unquote("/" + uri[5:].lstrip("/")), "rb") if local else where[0].open_input_stream(where[1]) as f:
                    while part := f.read(block):
                        h.update(part)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["path", "sha256"])

    return names.repartition("path").mapInArrow(digest, "path string, sha256 string")
