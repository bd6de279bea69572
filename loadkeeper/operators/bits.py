"""Sets of bits of fixed size as scalars: exact ones of small numbers, and filters that stand for any number of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A filter has 2 ** SIZE bits, 512 KB; every key sets TRIES of them.
SIZE, TRIES = 22, 2


def numbers(rows: DataFrame, number: Column, size: int) -> Column:
    """The numbers below 2 ** ``size`` that occur, as a scalar: longs of 64 bits each, at their places."""
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("n", F.lit(64)).cast("int"))
    words = rows.select(number.cast("bigint").alias("n")).groupBy(F.shiftright("n", 6).alias("at")).agg(F.bit_or(one).alias("word"))
    places = rows.sparkSession.range(max(1, (1 << size) // 64)).select(F.col("id").alias("at"), F.lit(0).cast("bigint").alias("word"))
    whole = words.unionByName(places).groupBy("at").agg(F.bit_or("word").alias("word"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"])).scalar()


def holds(held: Column, number: Column) -> Column:
    """Whether a number is in the set."""
    word = F.get(held, F.shiftright(number, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, F.pmod(number, F.lit(64)).cast("int")).bitwiseAND(1) == 1


def _bit(key: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(turn)), F.lit(1 << SIZE))


def of(keys: DataFrame, key: str) -> Column:
    """A filter that turns away only what is not among the keys; null keys set nothing."""
    each = F.explode(F.array(*[_bit(F.col(key), t) for t in range(TRIES)])).alias("bit")
    return numbers(keys.filter(F.col(key).isNotNull()).select(each), F.col("bit"), SIZE)


def may_hold(held: Column, key: Column) -> Column:
    """False for a key that is certainly none of those; NULL keys pass on to whatever decides."""
    out = key.isNull()
    found = F.lit(True)
    for turn in range(TRIES):
        found = found & holds(held, _bit(key, turn))
    return out | found
