"""Dataset refresh planning: which tables and partitions of a dataset to refresh, and the request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import Moment, month_key, month_keys
from loadkeeper.functions.text import empty, fold, in_names
from loadkeeper.operators.gates import ITEM, succeeded
from loadkeeper.operators.joins import not_in, paged_text

PLAN = ["batch_id", "datasetid", "execution_sequence"]


def one_spelling(config: DataFrame, column: str = "datasetid") -> DataFrame:
    """The config with one spelling for names that only differ in case or trailing blanks: the smallest of them."""
    spelled = config.groupBy(fold(column).alias("_folded")).agg(F.min(column).alias("_one"))
    same = config.withColumn("_folded", fold(column)).join(spelled, "_folded", "left")
    return same.withColumn(column, F.coalesce("_one", column)).select(*config.columns)


def for_batches(config: DataFrame, batches: Sequence[int]) -> DataFrame:
    """The enabled config entries once per dataset batch, datasets in one spelling; a dataset batch covers all sources."""
    config = one_spelling(config)
    ids = F.array(*[F.lit(b).cast("bigint") for b in batches])
    return config.filter("enabled").withColumn("batch_id", F.explode(ids))


def in_batches(df: DataFrame, batches: Sequence[int]) -> DataFrame:
    return df.filter(F.col("batch_id").isin(*batches))


def done_entries(config: DataFrame, log: DataFrame, batches: Sequence[int]) -> DataFrame:
    """Enabled entries whose domain has a success row in the batch."""
    done = succeeded(in_batches(log, batches)).withColumnRenamed(ITEM, "domain_id")
    return config.filter("enabled").select("id", "domain_id").join(done, "domain_id")


def dataset_list(config: DataFrame, log: DataFrame, batches: Sequence[int], *, saturday: bool, datasets=None) -> DataFrame:
    """Datasets with work left, per batch and sequence; weekly entries only run on Saturday.

    Outside Saturday entries without a frequency drop out too, as ``<> 'W'`` is unknown for them.
    """
    rows = for_batches(config, batches)
    if not saturday:
        rows = rows.filter(fold("job_frequency") != "w")
    if datasets:
        rows = rows.filter(in_names("datasetid", datasets))
    done = done_entries(config, log, batches).select("batch_id", "id").distinct()
    return rows.join(done, ["batch_id", "id"], "left_anti").select(*PLAN).distinct()


def open_entries(config: DataFrame, log: DataFrame, batches: Sequence[int]) -> DataFrame:
    """Enabled entries whose domain is NOT IN the succeeded domains of the batch."""
    done = done_entries(config, log, batches).select("batch_id", "domain_id")
    return not_in(for_batches(config, batches), done, "domain_id", ["batch_id"])


def rolling_months(now: Moment, first: int = -1, last: int = 2) -> Column:
    """No partition, or a month from ``first`` to ``last`` around now (server clock); '' is a name."""
    return F.col("partition_name").isNull() | month_key("partition_name").isin(*month_keys(now, first, last))


def from_month(now: Moment, first: int = -1) -> Column:
    """No partition, or any month from ``first`` on."""
    return F.col("partition_name").isNull() | (month_key("partition_name") >= month_keys(now, first, first)[0])


def plan_entries(
    config: DataFrame,
    log: DataFrame,
    batches: Sequence[int],
    *,
    mode: str = "full",
    now: Moment | None = None,
    partition: str | None = None,
) -> DataFrame:
    """The table and partition entries to refresh, per batch, dataset and sequence.

    Modes: ``full`` all open entries; ``months`` those of the rolling months; ``partition`` one
    partition; ``quarters`` all enabled entries by quarter number, succeeded or not.
    """
    if mode == "quarters":
        entries = quarter_entries(config, batches)
    else:
        entries = open_entries(config, log, batches)
        if mode == "months":
            entries = entries.filter(rolling_months(now))
        elif mode == "partition":
            entries = entries.filter(fold("partition_name") == partition.rstrip(" ").lower())
    extra = ["quarter"] if mode == "quarters" else []
    return entries.select(*PLAN, *extra, "table_name", "partition_name")


def quarters(config: DataFrame) -> DataFrame:
    """Quarter numbers a dataset is planned by: 0 up to its number of distinct enabled quarters.

    A quarter without any config row gives no plan; one whose rows are all disabled gives an empty one.
    """
    number = F.expr("try_cast(quarter_name AS bigint)")
    enabled_name = F.when(F.col("enabled"), fold("quarter_name"))
    config = one_spelling(config)
    limits = config.groupBy("datasetid").agg(F.countDistinct(enabled_name).alias("_limit"))
    return (
        config.select("datasetid", number.alias("quarter"))
        .distinct()
        .join(limits, "datasetid")
        .filter((F.col("quarter") >= 0) & (F.col("quarter") < F.col("_limit")))
        .select("datasetid", "quarter")
    )


def quarter_entries(config: DataFrame, batches: Sequence[int]) -> DataFrame:
    rows = for_batches(config, batches).withColumn("quarter", F.expr("try_cast(quarter_name AS bigint)"))
    return rows.join(quarters(config), ["datasetid", "quarter"], "left_semi")


def recalc_entries(config: DataFrame, log: DataFrame, batches: Sequence[int]) -> DataFrame:
    """Distinct tables to recalculate, per batch, dataset and sequence; of several spellings of a table the smallest."""
    rows = open_entries(config, log, batches).filter(fold("recalc_consider") == "y")
    return rows.groupBy(*PLAN, fold("table_name").alias("_folded")).agg(F.min("table_name").alias("table_name")).drop("_folded")


def dataset_heads(config: DataFrame, by: Sequence[str] = ("datasetid",)) -> DataFrame:
    """Per dataset: its first domain with that row's group, and its parallelism setting."""
    config = one_spelling(config)
    row = F.when(F.col("domain_id").isNotNull(), F.struct("domain_id", "groupid"))
    heads = config.groupBy(*by).agg(F.min(row).alias("_head"), F.min("maxparallelism").alias("maxparallelism"))
    return heads.select(*by, F.col("_head.domain_id").alias("job_object_id"), F.col("_head.groupid").alias("groupid"), "maxparallelism")


# The parts of a refresh request.
FULL_PLAIN = '{"type":"full","objects":['
FULL_PARALLEL = '{"type":"full","commitMode":"transactional","maxParallelism":'
FULL_PARALLEL_REST = ',"retryCount":1,"objects":['
CALCULATE = '{"type":"calculate","objects":['
CLOSE = "]}"
NO_PARALLEL = "na"


def entry_text() -> Column:
    """One object of a request; NULL and '' partitions are left out."""
    partition = F.when(~empty("partition_name"), F.col("partition_name")).alias("partition")
    return F.to_json(F.struct(F.col("table_name").alias("table"), partition))


def full_payload(
    entries: DataFrame, config: DataFrame, *, by: Sequence[str] = (), max_objects: int | None = None, asked: DataFrame | None = None
) -> DataFrame:
    """The refresh request per batch, dataset and sequence (and quarter, with ``by``).

    ``asked`` has the batches, datasets and sequences to answer; one without entries gets a request with an empty
    list. Without it only those with entries get one. One request holds all entries. With ``max_objects`` it is split into pages of about that many.
    """
    group = [*PLAN, *by]
    pages = paged_text(entries, group, key=entry_text(), text=entry_text(), page_rows=max_objects, sep=",")
    if asked is not None:
        # asked for in any spelling
        names = one_spelling(config).select(fold("datasetid").alias("_folded"), F.col("datasetid").alias("_one")).distinct()
        asked = asked.withColumn("_folded", fold("datasetid")).join(names, "_folded", "left").withColumn("datasetid", F.coalesce("_one", "datasetid"))
        pages = asked.select(*group).distinct().join(pages, group, "left")
        pages = pages.withColumns({"page": F.coalesce("page", F.lit(0).cast("bigint")), "body": F.coalesce("body", F.lit(""))})
    parallel = F.concat(F.lit(FULL_PARALLEL), F.col("maxparallelism"), F.lit(FULL_PARALLEL_REST))
    # A missing setting takes the plain form, like the setting 'NA'.
    head = F.when(fold("maxparallelism") != NO_PARALLEL, parallel).otherwise(F.lit(FULL_PLAIN))
    return (
        pages.join(dataset_heads(config), "datasetid")
        .select(*group, "page", "job_object_id", "groupid", F.concat(head, "body", F.lit(CLOSE)).alias("final_body"))
    )


def calculate_payload(entries: DataFrame, *, max_objects: int | None = None) -> DataFrame:
    """The recalculation request per batch, dataset and sequence."""
    text = F.to_json(F.struct(F.col("table_name").alias("table")))
    pages = paged_text(entries, PLAN, key=text, text=text, page_rows=max_objects, sep=",")
    return pages.select(*PLAN, "page", F.concat(F.lit(CALCULATE), "body", F.lit(CLOSE)).alias("final_body_recalc"))


def quarter_plan(config: DataFrame, batches: Sequence[int], *, max_objects: int | None = None) -> DataFrame:
    """One refresh request per dataset, sequence and quarter, with an empty object list where a
    quarter has config rows but none of them is enabled for the sequence."""
    requests = full_payload(quarter_entries(config, batches), config, by=["quarter"], max_objects=max_objects)
    sequences = for_batches(config, batches).select(*PLAN).distinct()
    wanted = sequences.join(quarters(config), "datasetid")
    number = one_spelling(config).withColumn("quarter", F.expr("try_cast(quarter_name AS bigint)"))
    heads = dataset_heads(number, ["datasetid", "quarter"]).drop("maxparallelism")
    settings = one_spelling(config).groupBy("datasetid").agg(F.min("maxparallelism").alias("maxparallelism"))
    parallel = F.concat(F.lit(FULL_PARALLEL), F.col("maxparallelism"), F.lit(FULL_PARALLEL_REST))
    head = F.when(fold("maxparallelism") != NO_PARALLEL, parallel).otherwise(F.lit(FULL_PLAIN))
    return (
        wanted.join(requests.drop("job_object_id", "groupid"), [*PLAN, "quarter"], "left")
        .join(heads, ["datasetid", "quarter"])
        .join(settings, "datasetid")
        .select(
            *PLAN, "quarter", F.coalesce("page", F.lit(0)).cast("bigint").alias("page"), "job_object_id", "groupid",
            F.coalesce("final_body", F.concat(head, F.lit(CLOSE))).alias("final_body"),
        )
    )
