"""Column helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The ASCII white space that separates words, as a regex class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE = re.compile(SPACE_CLASS.encode())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once: a lambda variable is never copied into the places that use it."""
    return F.transform(F.array(value), body)[0]


def position(key: Column) -> Column:
    """A place on a ring of 2^60: the first 15 hex digits of the MD5."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def utf8_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def power_of_two(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def pieces(text: bytes, size: int = 1_000_000) -> Iterator[bytes]:
    """A text in pieces that end between words."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, start + size) if start + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def run_batches(batches: Iterator, linked):
    """`linked` of whole runs, in a stream sorted by `run`."""
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        run = held.column("run").to_numpy()
        if not len(run):
            continue
        last = int(np.searchsorted(run, run[-1]))  # the last run may go on in the next batch
        if last:
            yield linked(held.slice(0, last).combine_chunks())
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield linked(held.combine_chunks())
