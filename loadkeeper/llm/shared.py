"""Cutting lineage, and fixed byte rules the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkeeper import session

#: The white space that ends a word; the same bytes that ``bytes.split()`` splits at.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the folder all executors share; a lost executor never recomputes them.

    The folder is the one in ``spark.checkpoint.dir``. A session on one machine without it, as in tests, gets a
    temporary one; on a cluster that is an error.
    """
    return session.cut(df)


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Python workers get rows in batches of about ``size`` bytes, unless the session has a bound of its own.

    A batch is 10,000 rows otherwise, which as whole documents may be any number of bytes in each worker and its executor.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text in order: what lies between white space. None for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def folded_words(text: Column) -> Column:
    """The runs of letters and digits, in lower case: what survives changes of case and decoration."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def shingle_hashes(words: Column, width: int) -> Column:
    """One 64-bit hash for every run of ``width`` words; fewer words give one for the whole sequence.

    The words are hashed one after the other, so no text is joined. No words give an empty array.
    """

    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - width, F.least(F.size(w) - 1, F.lit(0)))
        return F.transform(F.slice(w, 1, last + 1), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, width)]))

    return F.transform(F.array(words), hashes)[0]  # binds the words, which are then split once
