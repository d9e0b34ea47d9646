"""Helpers of the text operators: shared storage, word splitting, hashing."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1
"""A null id sorts after every other id."""


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A pass over batches after which the worker, which lives on, hands its free memory back to the system."""

    @functools.wraps(run)
    def passed(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return passed


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share, or else below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, kid, khash``: (kid, khash) identifies a row, but for rows that are wholly equal.

    A null text is empty. Other columns are left out, so that they cannot clash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("kid"), F.xxhash64("text").alias("khash")
    )


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: row bounds, code of each word, the distinct words.

    Long batches hold more than 2 GiB of words only if one batch does; large types avoid that bound too.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    split = split.cast(pa.large_list(pa.large_string()))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    offsets = offsets - offsets[0]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return before[offsets], coded.indices.to_numpy().astype(np.int64), coded.dictionary


def hash_words(distinct: pa.Array, lower: bool = False) -> np.ndarray:
    """64-bit hash of each distinct word, if wanted with A-Z in lower case."""
    h, raw = xxhash.xxh3_64_intdigest, distinct.cast(pa.large_binary()).to_pylist()
    return np.fromiter((h(w.lower() if lower else w) for w in raw), np.uint64, len(raw))


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive numbers; runs that cross rows are the caller's to drop."""
    if len(codes) < n:
        return np.empty(0, np.uint64)
    m = len(codes) - n + 1
    total = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * MULTIPLIER + codes[i : i + m]
        return mix(total)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each ``width`` consecutive values, by doubling spans."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    place, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        span += step
    return place[:n]
