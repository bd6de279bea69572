"""Set tests on keys that behave like SQL's NOT IN, and the rows of a group as text."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.session import cut

#: Keys the summary of frequent keys follows at a time; a key is found if it has more than about 3.5 of so many rows.
FOLLOWED = 10_000
#: With up to so many tasks every key goes to all of them: copying the few group rows costs less than measuring.
FEW_TASKS = 64
#: A key is split so that none of its parts has more than this share of what each task would have if all had the same.
SHARE = 0.5


def not_in(left: DataFrame, right: DataFrame, key: str, by: Sequence[str] = (), spread: Sequence[str] = ()) -> DataFrame:
    """``left`` rows whose ``key`` is NOT IN the right-hand keys of the same ``by`` group.

    A NULL on the right empties its whole group, and a NULL on the left survives only where the
    group has no right-hand rows at all. The engine's own NOT IN broadcasts the right side whatever
    its size; here the keys go through an ordinary anti join, and the NULL rule needs one flag per
    group: a scalar without groups, else a join salted by the key so that a hot group is spread; ``spread``
    names further columns to salt by, where many rows may have no key.
    """
    by = list(by)
    keys = right.select(*by, key).distinct()
    present = keys.filter(F.col(key).isNotNull())
    kept = left.join(present, by + [key], "left_anti")
    has_null = F.max(F.col(key).isNull())
    if not by:
        flag = keys.agg(has_null).scalar()
        return kept.filter(flag.isNull() | (~flag & F.col(key).isNotNull()))
    groups = keys.groupBy(*by).agg(has_null.alias("_has_null"))
    flag = F.col("_has_null")
    # There are few groups, and the rows are dear to compute: so every group is spread over all tasks, without measuring.
    return (
        spread_join(kept, groups, by, salt=F.hash(key, *spread), parts=F.lit(tasks_of(left)))
        .filter(flag.isNull() | (~flag & F.col(key).isNotNull()))
        .select(*left.columns)
    )


def shuffled(rows: DataFrame) -> DataFrame:
    """A side of a join that is as large as the tables it is made of: shuffled by the key and sorted, never sent whole to every task.

    Sizes are estimated from compressed files and know nothing of rows that one row becomes, so a side of many million rows
    can look small enough to be broadcast, which takes it through the driver.
    """
    return rows.hint("merge")


def tasks_of(rows: DataFrame) -> int:
    """How many tasks a shuffle of these rows may have side by side."""
    spark = rows.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def parts_of(rows: DataFrame, by: Sequence[str]) -> Column:
    """Into how many parts the rows of each key are to be split: 1 but for the keys with a large share of all rows.

    One pass over the keys keeps a mergeable summary of the frequent ones, of fixed size, and their counts; a key gets
    as many parts as its count holds fair shares of a task, so the number follows the size of the cluster.
    """
    tasks = tasks_of(rows)
    if tasks <= FEW_TASKS:
        return F.lit(tasks)
    frequent = F.call_function("approx_top_k", F.xxhash64(*by), F.lit(2 * tasks), F.lit(max(FOLLOWED, 8 * tasks)))
    fair = F.greatest(F.lit(1.0), F.count("*") * F.lit(SHARE / tasks))
    split = F.transform(frequent, lambda x: F.struct(x["item"], F.ceil(x["count"] / fair).cast("int").alias("parts")))
    parts = rows.agg(F.map_from_entries(F.filter(split, lambda x: x["parts"] > 1))).scalar()
    return F.coalesce(F.element_at(parts, F.xxhash64(*by)), F.lit(1))


def spread_join(
    rows: DataFrame, groups: DataFrame, by: Sequence[str], *, salt: Column, how: str = "left", parts: Column | None = None
) -> DataFrame:
    """Rows joined with the rows of ``groups`` on ``by``, a key of few values.

    The rows of a frequent key go to several tasks, by ``salt``, and its group rows to each of them. Which keys are frequent is
    measured, unless ``parts`` says into how many parts any key goes.
    """
    parts = parts_of(rows, by) if parts is None else parts
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return rows.withColumn("_salt", F.pmod(salt, parts)).join(copies, [*by, "_salt"], how).drop("_salt")


def page_of(key: Column, pages: Column) -> Column:
    """A page number below ``pages`` from a text key; the same for the same key everywhere."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), pages)


@dataclass(frozen=True)
class Pieces:
    """Texts in pieces of exactly ``rows`` rows, in order, the last one of a group shorter."""

    rows: int = 1000


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with ``_place`` 0, 1, 2 ... in their group by ``order``, and ``_size`` of the group.

    All rows are sorted together over many partitions, so a group with most of them spreads evenly, and are written. Where a
    group begins in each partition, and what the partitions before hold, is all that is needed to number them.
    """
    group = list(group)
    place = F.monotonically_increasing_id()
    part, at = F.shiftright(place, 33).cast("int"), place.bitwiseAND((1 << 33) - 1)
    laid = cut(rows.orderBy(*group, *order).select("*", part.alias("_part"), at.alias("_at")))
    held = laid.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    sizes = {r["_part"]: r["n"] for r in laid.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before = dict(zip(sorted(sizes), itertools.accumulate((sizes[p] for p in sorted(sizes)), initial=0)))
    start = F.element_at(F.create_map(*[F.lit(x) for p in before.items() for x in p]), F.col("_part")) if before else F.lit(0)
    held = held.withColumn("_start", start.cast("bigint"))
    own = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    same_group = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)])
    whole = held.groupBy(*own).agg(F.min(F.col("_start") + F.col("_first")).alias("_begin"), F.sum("_rows").alias("_size"))
    held = held.join(whole, same_group).select(F.col("_part").alias("_p"), *own, "_start", "_begin", "_size")
    number = F.col("_start") + F.col("_at") - F.col("_begin")
    return laid.join(held, (F.col("_part") == F.col("_p")) & same_group).select(*rows.columns, number.alias("_place"), "_size")


def pieced_text(rows: DataFrame, group: Sequence[str], *, key: Column, text: Column, pieces: Pieces, sep: str = "") -> DataFrame:
    """The rows of every group as text in pieces: (group, page, body, n_rows, n_pages), the same shape at every size.

    Bodies joined in the order of ``page``, with ``sep``, are the whole text in key order.
    """
    group = list(group)
    rows = rows.select(*group, key.alias("_key"), text.alias("_text"))
    page, lines = F.floor(F.col("_place") / F.lit(pieces.rows)), F.sort_array(F.collect_list(F.struct("_place", "_text")))
    numbered = placed(rows, group, ["_key", "_text"]).withColumn("page", page)
    body = F.array_join(F.transform(lines, lambda r: r["_text"]), sep)
    out = numbered.groupBy(*group, "page").agg(body.alias("body"), F.count("*").alias("n_rows"), F.max("_size").alias("_size"))
    return out.select(*group, "page", "body", "n_rows", F.ceil(F.col("_size") / F.lit(pieces.rows)).alias("n_pages"))


def paged_text(
    rows: DataFrame, group: Sequence[str], *, key: Column, text: Column, page_rows: int | Pieces | None = None, sep: str = ""
) -> DataFrame:
    """The rows of every group joined to one text, in key order; ``page`` is 0.

    A group's text is one value whatever its size; with ``Pieces`` it comes in ordered pieces. With ``page_rows`` a group comes in pages of about that many rows
    instead: a row's page follows from its key's hash and, for equal rows, its number among them, so
    equal rows spread like others. Equal rows are counted before anything is shuffled by group.
    """
    if isinstance(page_rows, Pieces):
        return pieced_text(rows, group, key=key, text=text, pieces=page_rows, sep=sep)
    group = list(group)
    rows = rows.select(*group, key.alias("_key"), text.alias("_text"))
    equal = rows.groupBy(*group, "_key", "_text").agg(F.count("*").alias("_n"))
    if page_rows is None:
        listed = F.sort_array(F.collect_list(F.struct("_key", "_text", "_n")))
        repeated = F.flatten(F.transform(listed, lambda r: F.array_repeat(r["_text"], r["_n"].cast("int"))))
        whole = equal.groupBy(*group).agg(F.array_join(repeated, sep).alias("body"), F.sum("_n").alias("n_rows"))
        return whole.select(*group, F.lit(0).cast("bigint").alias("page"), "body", "n_rows")
    sizes = equal.groupBy(*group).agg(F.ceil(F.sum("_n") / F.lit(page_rows)).alias("_pages"))
    copies = equal.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)))
    page = F.pmod(page_of(F.col("_key"), F.col("_pages")) + F.col("_copy"), F.col("_pages"))
    paged = spread_join(copies, sizes, group, salt=F.hash("_key", "_copy")).withColumn("page", page)
    listed = F.sort_array(F.collect_list(F.struct("_key", "_text")))
    return paged.groupBy(*group, "page").agg(
        F.array_join(F.transform(listed, lambda r: r["_text"]), sep).alias("body"),
        F.count("*").alias("n_rows"),
    )
