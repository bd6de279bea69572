"""Change tracking: row audit, schema drift, domain checks."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import Moment, wall
from loadkeeper.functions.text import fold, fold_text
from loadkeeper.operators import bits

# The values the control tables accept.
BATCH_STATES = ("Active", "Failed", "Partially Failed", "Successfully Completed")
ERROR_TYPES = ("UserError", "TechnicalError", "DQCheckError")
ERROR_SUBTYPES = (
    "ConfigurationError", "MetadataError", "SchemaBindingError", "ReadStreamError", "WriteStreamError",
    "SPError", "NullCheckError", "DuplicateCheckError", "LengthCheckError", "TypeCheckError", "RangeError",
    "LogicalError",
)
MAPPING_STATES = ("Not Started",)


def row_changes(
    old: DataFrame, new: DataFrame, key: Sequence[str], *, user: str, now: Moment, skip: Sequence[str] = ()
) -> DataFrame:
    """Rows inserted, updated or deleted between two versions of a table.

    Inserts and updates give the row as it is now, deletes as it was, with who and when. Columns in
    ``skip`` are compared but not carried over. An update that changes nothing leaves no trace.
    """
    columns = new.columns
    before = old.select(*key, F.struct(*columns).alias("_old"))
    after = new.select(*key, F.struct(*columns).alias("_new"))
    activity = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("_new").isNull(), "DELETE")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "UPDATE")
    )
    return (
        before.join(after, list(key), "full_outer")
        .withColumn("Activity", activity)
        .filter(F.col("Activity").isNotNull())
        .select(F.coalesce("_new", "_old").alias("_row"), "Activity")
        .select(
            *[F.col(f"_row.{c}").alias(c) for c in columns if c not in skip],
            "Activity",
            F.lit(user).alias("change_doneBy"),
            wall(now).alias("modify_date"),
        )
    )


#: Bits of a key's hash that number its range, coarse and fine.
COARSE, FINE = 8, 16


def _sums(rows: DataFrame, depth: int, side: str) -> DataFrame:
    """Per range of keys: rows and two sums of their hashes. Which columns are NULL is hashed too."""
    part = F.shiftrightunsigned("_key", 64 - depth)
    low = F.sum(F.col("_row").bitwiseAND(0xFFFFFFFF))
    return rows.groupBy(part.alias("range")).agg(F.struct(F.count("*"), F.bit_xor("_row"), low).alias(side))


def changed_ranges(old: DataFrame, new: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both snapshots cut to the ranges of keys in which they differ.

    A tree of sums over ranges of the hashed key is compared from the top: first 256 ranges, then 256 in each that
    differs. Only sums are shuffled for that, a few numbers per range and task. A range that differs keeps all its
    rows; ranges of as many rows with the same 96 bits of sums are taken for equal. Rows without a whole key, which
    compare as equal to nothing, stay.
    """
    whole_key = functools.reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in key])

    def hashed(df: DataFrame) -> DataFrame:
        marks = [F.col(c).isNull() for c in new.columns]
        return df.withColumns({"_key": F.xxhash64(*key), "_row": F.xxhash64(*new.columns, *marks)})

    left, right = hashed(old), hashed(new)
    for depth in (COARSE, FINE):
        both = _sums(left, depth, "a").join(_sums(right, depth, "b"), "range", "full_outer")
        differ = bits.numbers(both.filter(~F.col("a").eqNullSafe(F.col("b"))), F.col("range"), depth)
        keep = bits.holds(differ, F.shiftrightunsigned("_key", 64 - depth)) | ~whole_key
        left, right = left.filter(keep), right.filter(keep)
    return left.drop("_key", "_row"), right.drop("_key", "_row")


def row_changes_by_range(
    old: DataFrame, new: DataFrame, key: Sequence[str], *, user: str, now: Moment, skip: Sequence[str] = ()
) -> DataFrame:
    """``row_changes`` of large tables that differ little: only the ranges of keys that differ are joined. Keys are unique."""
    return row_changes(*changed_ranges(old, new, key), key, user=user, now=now, skip=skip)


def classify_changes(changes: DataFrame, *, user: str, now: Moment, keep: Sequence[str] = ()) -> DataFrame:
    """``row_changes`` for a feed of (before, after) structs, batch or stream.

    A feed also carries updates that change nothing, and those are kept, as a row trigger keeps them. ``keep`` names
    further columns of the feed that come along.
    """
    activity = (
        F.when(F.col("before").isNull() & F.col("after").isNotNull(), "INSERT")
        .when(F.col("after").isNull() & F.col("before").isNotNull(), "DELETE")
        .when(F.col("after").isNotNull(), "UPDATE")
    )
    return (
        changes.withColumn("Activity", activity)
        .filter(F.col("Activity").isNotNull())
        .withColumn("_row", F.coalesce("after", "before"))
        .select("_row.*", "Activity", F.lit(user).alias("change_doneBy"), wall(now).alias("modify_date"), *keep)
    )


def replay(audit: DataFrame, key: Sequence[str], order: Sequence[str] = ("modify_date",)) -> DataFrame:
    """The table as its audit rows leave it: the last row of each key by ``order``, unless that deletes it.

    Updates count as inserts, so it does not matter in what order the rows stand or were written.
    """
    columns = [c for c in audit.columns if c not in (*key, *order, "Activity", "change_doneBy", "modify_date")]
    row = F.struct(*order, "Activity", F.struct(*columns).alias("row"))
    last = audit.groupBy(*key).agg(F.max(row).alias("last")).filter("last.Activity <> 'DELETE'")
    return last.select(*key, "last.row.*")


def schema_rows(df: DataFrame, owner: str, table_name: str) -> DataFrame:
    """A table's columns as rows of the column catalogue."""
    rows = [
        (owner, table_name, f.name, i + 1, f.dataType.simpleString(), "Y" if f.nullable else "N")
        for i, f in enumerate(df.schema.fields)
    ]
    ddl = "owner string, table_name string, column_name string, column_id int, data_type string, nullable string"
    return df.sparkSession.createDataFrame(rows, ddl)


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns added, dropped or altered between two column catalogues, with the matching statement."""
    key = ["owner", "table_name", "column_name"]
    names = [fold(c).alias(f"_{c}") for c in key]
    traits = F.struct(fold("data_type").alias("data_type"), "data_length", fold("nullable").alias("nullable"))
    side = lambda df, tag: df.select(
        *names, F.struct(*key, "data_type").alias(tag), traits.alias(f"{tag}_traits")
    )
    joined = side(old, "_old").join(side(new, "_new"), [f"_{c}" for c in key], "full_outer")
    event = (
        F.when(F.col("_old").isNull(), "ADD")
        .when(F.col("_new").isNull(), "DROP")
        .when(~F.col("_old_traits").eqNullSafe(F.col("_new_traits")), "ALTER")
    )
    changed = (
        joined.withColumn("event_type", event)
        .filter(F.col("event_type").isNotNull())
        .withColumn("_row", F.coalesce("_new", "_old"))
        .select("event_type", "_row.*")
    )
    table = F.concat_ws(".", "owner", "table_name")
    command = (
        F.when(F.col("event_type") == "ADD", F.concat_ws(" ", F.lit("ALTER TABLE"), table, F.lit("ADD"), "column_name", "data_type"))
        .when(F.col("event_type") == "DROP", F.concat_ws(" ", F.lit("ALTER TABLE"), table, F.lit("DROP COLUMN"), "column_name"))
        .otherwise(F.concat_ws(" ", F.lit("ALTER TABLE"), table, F.lit("ALTER COLUMN"), "column_name", "data_type"))
    )
    return changed.select("event_type", *key, command.alias("command_text"))


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with a value outside its column's list, and the names of those columns; NULL passes."""
    bad = [
        F.when(~fold(c).isin(*[fold_text(v) for v in allowed]), F.lit(c)) for c, allowed in domains.items()
    ]
    return df.withColumn("violations", F.array_compact(F.array(*bad))).filter(F.size("violations") > 0)
