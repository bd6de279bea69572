"""A filter of fixed size over 64-bit keys: what it turns away is not among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter has 2 ** BITS bits, 1 MB, however many keys it holds; each key sets PROBES of them.
BITS, PROBES = 23, 2


def _places(key: Column) -> list[Column]:
    """PROBES numbers below 2 ** BITS, from separate bits of the key's hash."""
    mixed = F.xxhash64(key)
    return [F.shiftrightunsigned(mixed, p * BITS).bitwiseAND((1 << BITS) - 1).cast("int") for p in range(PROBES)]


def build(keys: DataFrame, key: str) -> Column:
    """The filter as a scalar: array<bigint> of 64 bits each. Null keys are left out; no keys give an empty filter."""
    place = F.explode(F.array(*_places(F.col(key))))
    places = keys.filter(F.col(key).isNotNull()).select(place.alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63))).alias("bits")
    )
    every = words.sparkSession.range(1 << BITS - 6).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    whole = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return whole.agg(F.transform(in_order, lambda w: w["bits"]).alias("bits")).scalar()


def may_hold(bits: Column, key: Column) -> Column:
    """False if the key is certainly not in the filter."""
    out = F.lit(True)
    for place in _places(key):
        word = F.get(bits, F.shiftright(place, 6))
        out = out & (F.call_function("shiftrightunsigned", word, place.bitwiseAND(63)).bitwiseAND(1) == 1)
    return out
