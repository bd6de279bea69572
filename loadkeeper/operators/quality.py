"""Column-level quality rules, column mapping, and keyed upserts.

The rules come from the column mapping table: one entry per column of one loaded table, so they are
configuration of the width of a schema and are read on the driver. All checks run in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.operators.tables import last_changes


@dataclass(frozen=True)
class Rule:
    """What the mapping says about one column."""

    column: str
    target: str | None = None
    data_type: str | None = None
    nullable: bool = True
    expression: str | None = None
    length: int | None = None
    range_expression: str | None = None
    alphanumeric: bool = False
    natural_key: bool = False
    unique: bool = False
    null_combination: bool = False
    column_id: int = 0


def rules_from(mapping: DataFrame) -> list[Rule]:
    """Rules of the active rows of a column mapping table, for one loaded table."""
    rows = mapping.filter("upper(actv_flg) = 'Y'").collect()
    on = lambda r, flag: r[flag] == 1
    rules = [
        Rule(
            column=r["source_column_name"],
            target=r["target_column_name"],
            data_type=r["target_column_data_type"],
            nullable=(r["is_nullable"] or "Y").strip().upper() != "N",
            expression=r["transformation_rule"],
            length=r["length"] if on(r, "length_key_flag") else None,
            range_expression=r["range_expression"] if on(r, "range_key_flag") else None,
            alphanumeric=on(r, "alphanumeric_key_flag"),
            natural_key=on(r, "natural_key_flag"),
            unique=on(r, "uniqueness_key_flag"),
            null_combination=on(r, "null_check_nk_combination_flag"),
            column_id=r["column_id"] or 0,
        )
        for r in rows
    ]
    return sorted(rules, key=lambda r: (r.column_id, r.column))


def _failed(condition: Column, error: str, column: str) -> Column:
    return F.when(condition, F.lit(f"{error}:{column}"))


def quality_errors(df: DataFrame, rules: Sequence[Rule], *, check_types: bool = True) -> DataFrame:
    """Adds ``dq_errors``: the failed checks of every row as 'Subtype:column'."""
    found = []
    for r in rules:
        c = F.col(r.column)
        if not r.nullable:
            found.append(_failed(c.isNull(), "NullCheckError", r.column))
        if r.length is not None:
            found.append(_failed(F.length(c.cast("string")) > r.length, "LengthCheckError", r.column))
        if check_types and r.data_type and r.expression is None:
            found.append(_failed(c.isNotNull() & c.try_cast(r.data_type).isNull(), "TypeCheckError", r.column))
        if r.range_expression:
            found.append(_failed(~F.expr(r.range_expression), "RangeError", r.column))
        if r.alphanumeric:
            found.append(_failed(~c.cast("string").rlike(r"\A[A-Za-z0-9]+\z"), "TypeCheckError", f"{r.column} alphanumeric"))
    group = [r.column for r in rules if r.null_combination]
    if group:
        all_null = F.lit(True)
        for c in group:
            all_null = all_null & F.col(c).isNull()
        found.append(_failed(all_null, "NullCheckError", "+".join(group)))
    errors = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return df.withColumn("dq_errors", errors)


def quality_split(df: DataFrame, rules: Sequence[Rule], **options) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their ``dq_errors``)."""
    checked = quality_errors(df, rules, **options)
    bad = F.size("dq_errors") > 0
    return checked.filter(~bad).drop("dq_errors"), checked.filter(bad)


def write_checked(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Writes checked rows once, accepted and rejected apart, and returns (accepted, rejected, counts).

    The input is read a single time for both parts. The counts are taken from the written files, so
    retried tasks do not count twice.
    """
    spark = checked.sparkSession
    checked.withColumn("is_rejected", F.size("dq_errors") > 0).write.mode("error").partitionBy("is_rejected").parquet(path)
    written = spark.read.schema(checked.schema.add("is_rejected", "boolean")).parquet(path)
    accepted = written.filter("NOT is_rejected").drop("is_rejected", "dq_errors")
    rejected = written.filter("is_rejected").drop("is_rejected")
    counts = written.agg(
        F.count("*").alias("source_row_count"),
        F.count(F.when(~F.col("is_rejected"), 1)).alias("target_row_count"),
        F.count(F.when(F.col("is_rejected"), 1)).alias("rejeted_row_count"),
    )
    return accepted, rejected, counts


def quality_counts(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Source, target and rejected row counts of checked rows, for the audit row."""
    bad = F.size("dq_errors") > 0
    return checked.groupBy(*by).agg(
        F.count("*").alias("source_row_count"),
        F.count(F.when(~bad, 1)).alias("target_row_count"),
        F.count(F.when(bad, 1)).alias("rejeted_row_count"),
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order`` and then by the whole row, and ``n_rows`` of its key.

    The minimum is taken before and after the shuffle, so a key that holds a large part of the rows
    sends one row per task instead of all its rows.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], F.struct(*rest).alias("_row"))
    best = df.groupBy(*key).agg(F.min(ranked).alias("_best"), F.count("*").alias("n_rows"))
    return best.select(*key, *[F.col(f"_best._row.{c}").alias(c) for c in rest], "n_rows")


def duplicate_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many rows are rejected as their duplicates."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1")
    return counts.select(*key, (F.col("_n") - 1).alias("rejected_duplicate_count"))


def rejected_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows ``keep_first`` does not keep, equal rows once with their number in ``copies``."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    kept = keep_first(df, key, order).drop("n_rows").withColumn("_kept", F.lit(1))
    same_row = [rows[c].eqNullSafe(kept[c]) for c in df.columns]
    condition = same_row[0]
    for s in same_row[1:]:
        condition = condition & s
    joined = rows.join(kept, condition, "left").select(rows["*"], "_kept")
    left_over = joined.withColumn("copies", F.col("copies") - F.coalesce("_kept", F.lit(0)))
    return left_over.filter("copies > 0").drop("_kept")


def map_columns(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The target columns in order: renamed, transformed by their rule, cast to their type."""
    out = []
    for r in rules:
        value = F.expr(r.expression) if r.expression else F.col(r.column)
        out.append((value.cast(r.data_type) if r.data_type else value).alias(r.target or r.column))
    return df.select(*out)


def _one_change(changes: DataFrame, key: Sequence[str], rest: Sequence[str], order: Sequence[str]) -> DataFrame:
    if order:
        return last_changes(changes, key, rest, order, "_new")
    return changes.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_new"))


def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str], *, order: Sequence[str] = ()) -> DataFrame:
    """The target after inserting new keys and overwriting known ones, with ``action`` per row.

    Of several changes of one key the last by ``order`` counts (see ``tables.last_changes``), columns that the target need
    not have; without an order the smallest row, compared column by column. Actions: insert, update, same, keep.
    """
    rest = [c for c in target.columns if c not in key]
    old = target.select(*key, F.struct(*rest).alias("_old"))
    new = _one_change(changes, key, rest, order)
    action = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "keep")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same")
        .otherwise("update")
    )
    row = F.coalesce("_new", "_old")
    return (
        old.join(new, list(key), "full_outer")
        .withColumn("action", action)
        .withColumn("_row", row)
        .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest], "action")
    )


def upsert_counts(result: DataFrame) -> DataFrame:
    """Insert and update counts of an upsert, for the audit row."""
    n = lambda a: F.count(F.when(F.col("action") == a, 1))
    return result.agg(n("insert").alias("insert_row_count"), n("update").alias("update_row_count"))


def upsert_history(
    target: DataFrame, changes: DataFrame, key: Sequence[str], *, now: Column, valid_from="valid_from", valid_to="valid_to", order: Sequence[str] = ()
) -> DataFrame:
    """The target with row history: changed rows are closed at ``now`` and follow as new open rows.

    ``target`` carries the validity columns; open rows have a NULL end. Closed rows pass through. Of
    several changes of one key the last by ``order`` counts, without an order the smallest row.
    """
    rest = [c for c in changes.columns if c not in key and not (c in order and c not in target.columns)]
    closed = target.filter(F.col(valid_to).isNotNull())
    current = target.filter(F.col(valid_to).isNull())
    old = current.select(*key, F.struct(*rest).alias("_old"), F.col(valid_from).alias("_since"))
    new = _one_change(changes, key, rest, order)
    changed = F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))
    end = F.when(changed, now)
    # A changed row leaves two versions, the closed old one and the open new one.
    versions = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), F.struct(F.col("_old").alias("row"), F.col("_since").alias("a"), end.alias("b"))),
            F.when(changed, F.struct(F.col("_new").alias("row"), now.alias("a"), F.lit(None).cast("timestamp_ntz").alias("b"))),
        )
    )
    joined = old.join(new, list(key), "full_outer").select(*key, F.explode(versions).alias("_v"))
    open_rows = joined.select(
        *key, *[F.col(f"_v.row.{c}").alias(c) for c in rest], F.col("_v.a").alias(valid_from), F.col("_v.b").alias(valid_to)
    )
    return closed.select(*open_rows.columns).unionByName(open_rows)


def delete_rows(df: DataFrame, identifier: str) -> DataFrame:
    """Rows for which the delete predicate does not hold; unknown is not a delete."""
    return df.filter(~F.coalesce(F.expr(identifier), F.lit(False)))


def domains_of(rules: Sequence[Rule], allowed: Mapping[str, Sequence[str]]) -> dict[str, Sequence[str]]:
    """The domain lists of the mapped columns only."""
    return {r.column: allowed[r.column] for r in rules if r.column in allowed}
