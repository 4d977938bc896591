"""What the operators share: tables, word rules, row keys, checkpoints."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut, dropped, shared_folder, stored  # noqa: F401  (the operators')

#: Bytes that are part of a word: digits, letters (A-Z lower-cased) and everything beyond ASCII.
_WORD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: The same rule as a Java regular expression over lower-cased text.
WORD_REGEX = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text: A-Z lower-cased, split at ASCII characters that are neither letters nor digits."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def tokens(text: str | None) -> list[bytes]:
    """UTF-8 tokens of a text: A-Z lower-cased, split at space, tab, LF, VT, FF and CR only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches small enough that a batch of long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bucket_of(column: str, divisor: int):
    """crc32 of the id as text, modulo the divisor; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def tidied(batches: Iterator) -> Iterator:
    """The batches as they come; when a task's last is done, memory that the worker no longer uses goes back to the system."""
    yield from batches
    import ctypes

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library knows how
        ctypes.CDLL(None).malloc_trim(0)


def free_names(df: DataFrame, n: int) -> list[str]:
    """Names for n columns that the table, whatever its columns, doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    names = (f"__{k}" for k in range(n + len(taken)))
    return [x for x in names if x not in taken][:n]
