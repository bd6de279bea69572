"""Run reports: summary, success and failure details, lineage, and notification rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import duration_text, hours_minutes, seconds_between
from loadkeeper.functions.text import fold, same
from loadkeeper.operators.gates import ITEM, SUCCESS
from loadkeeper.operators.joins import Pieces, paged_text, shuffled, spread_join, tasks_of
from loadkeeper.operators.worklist import for_runs

RUN = ["batch_id", "source_id", "job_id"]


def run_summary(log: DataFrame, by: Sequence[str] = (*RUN, "status")) -> DataFrame:
    """Tables processed and time spent per run: minutes with four decimals, and HH:MM."""
    seconds = F.sum(seconds_between("object_start_date", "object_end_date"))
    minutes = (seconds / F.lit("60.0").cast("decimal(3,1)")).cast("decimal(20,4)")
    rows = log.withColumn("status", fold("status")) if "status" in by else log
    return (
        rows.groupBy(*by)
        .agg(F.count("*").alias("table_count"), minutes.alias("total_minutes"))
        .withColumn("total_time", hours_minutes(F.col("total_minutes")))
    )


def run_items(log: DataFrame, items: DataFrame) -> DataFrame:
    """Log rows with their work item; source and step must agree on both sides."""
    return log.join(shuffled(items), [ITEM, "source_id", "job_id"])


def success_detail(log: DataFrame, items: DataFrame, objects: DataFrame, *, null_counts_as_zero: bool = False) -> DataFrame:
    """One row per successful log row of an enabled item: duration, size in GB, row counts."""
    zero = (lambda c: F.coalesce(c, F.lit(0))) if null_counts_as_zero else F.col
    gigabytes = F.col("target_size").cast("decimal(27,8)") / F.lit(1024**3).cast("decimal(10,0)")
    chosen = items.filter(F.col("enabled") == 1).select(
        ITEM, "source_id", "job_id", "object_id", "source_object_name", "target_object_name", "execution_sequence"
    )
    # Items meet their objects first, so the log, the largest side, is shuffled once.
    chosen = chosen.join(shuffled(objects.select("object_id", "table_name")), "object_id")
    return (
        run_items(log.filter(same("status", SUCCESS)), chosen)
        .select(
            *RUN,
            ITEM,
            "table_name",
            "source_object_name",
            "target_object_name",
            "execution_sequence",
            duration_text("object_start_date", "object_end_date").alias("time_taken"),
            gigabytes.cast("decimal(20,8)").alias("size_gb"),
            zero("source_row_count").alias("source_row_count"),
            zero("target_row_count").alias("target_row_count"),
            zero("rejeted_row_count").alias("rejected_row_count"),
            zero("rejected_duplicate_count").alias("rejected_duplicate_count"),
            "status",
        )
    )


def first_errors(errors: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key the id of its first error row: by log date, rows without a date first, then by id."""
    first = F.min(F.struct(F.col("log_date").isNotNull().alias("dated"), "log_date", "error_log_id"))
    return errors.groupBy(*key).agg(first["error_log_id"].alias("error_log_id"), F.lit(True).alias("_error"))


def failure_detail(items: DataFrame, objects: DataFrame, log: DataFrame, errors: DataFrame, runs: DataFrame) -> DataFrame:
    """Enabled items of every run that have no success row, with their class and first error.

    'Failed' with an error row or a log row of the same source and step, else 'Skipped'. The log is
    scanned once and reduced to one row per batch, item, source and step before it is joined.
    """
    chosen = items.filter(F.col("enabled") == 1).select(
        ITEM, "source_id", "job_id", "object_id", "target_object_name", "execution_sequence"
    )
    key = [*RUN, ITEM]
    # Keys that cannot be NULL need no filter of their own, so both uses plan the same reduction and share its shuffle.
    place = [F.coalesce(F.col(c).cast("bigint"), F.lit(-1).cast("bigint")).alias(c) for c in ("batch_id", ITEM, "source_id", "job_id")]
    places = log.groupBy(*place).agg(F.max(F.coalesce(same("status", SUCCESS), F.lit(False))).alias("_ok"))
    done = places.filter("_ok").select("batch_id", ITEM).distinct()
    logged = places.select("batch_id", ITEM, "source_id", "job_id", F.col("_ok").isNotNull().alias("_logged"))
    due = for_runs(chosen, runs).join(done, ["batch_id", ITEM], "left_anti")
    due = due.join(shuffled(objects.select("object_id", "table_name")), "object_id")
    known = F.col("_error").isNotNull() | F.coalesce("_logged", F.lit(False))
    return (
        due.join(logged, key, "left")
        .join(first_errors(errors, key), key, "left")
        .select(
            *key,
            "table_name",
            "target_object_name",
            "execution_sequence",
            F.when(known, "Failed").otherwise("Skipped").alias("is_failed"),
            F.coalesce(F.col("error_log_id").cast("string"), F.lit("")).alias("error_log_id"),
        )
    )


def dataset_success(log: DataFrame, config: DataFrame) -> DataFrame:
    """Enabled dataset entries with a success row under their own id, per batch."""
    entries = config.filter("enabled").select("id", "domain_name", "table_name", "partition_name")
    rows = log.filter(same("status", SUCCESS)).select(
        "batch_id", F.col(ITEM).alias("id"), "object_start_date", "object_end_date"
    )
    return rows.join(shuffled(entries), "id").select(
        "batch_id", "id", "domain_name", "table_name", F.coalesce("partition_name", F.lit("")).alias("partition_name"),
        duration_text("object_start_date", "object_end_date").alias("time_taken"),
    )


def dataset_summary(log: DataFrame, config: DataFrame) -> DataFrame:
    """Entries refreshed and time spent per dataset batch."""
    ids = config.filter("enabled").select(F.col("id").alias(ITEM))
    rows = log.filter(same("status", SUCCESS)).join(shuffled(ids), ITEM, "left_semi")
    return run_summary(rows, by=("batch_id",))


def dataset_failure(
    config: DataFrame, log: DataFrame, errors: DataFrame, batches: Sequence[int], *, source_id: int, months: Column | None = None
) -> DataFrame:
    """Enabled dataset entries without a success row, with class and first error, per batch.

    ``months`` narrows the entries outside weekends and ad-hoc runs; see ``refresh.from_month``.
    """
    chosen = config.filter("enabled") if months is None else config.filter(F.col("enabled") & months)
    due = chosen.select("id", "domain_name", "table_name", "partition_name").withColumn(
        "batch_id", F.explode(F.array(*[F.lit(b).cast("bigint") for b in batches]))
    )
    key = ["batch_id", "id"]
    own = lambda df: df.filter(F.col("source_id") == source_id).withColumnRenamed(ITEM, "id")
    logged = own(log).groupBy(*key).agg(F.lit(True).alias("_logged"))
    failed = first_errors(own(errors), key)
    done = log.filter(same("status", SUCCESS)).select("batch_id", F.col(ITEM).alias("id")).distinct()
    return (
        due.join(done, key, "left_anti")
        .join(logged, key, "left")
        .join(failed, key, "left")
        .select(
            *key, "domain_name", "table_name", F.coalesce("partition_name", F.lit("")).alias("partition_name"),
            F.when(F.coalesce("_error", "_logged"), "Failed").otherwise("Skipped").alias("is_failed"),
            F.coalesce(F.col("error_log_id").cast("string"), F.lit("")).alias("error_log_id"),
        )
    )


def lineage(
    items: DataFrame, jobs: DataFrame, sources: DataFrame, objects: DataFrame,
    log: DataFrame, errors: DataFrame, mapping: DataFrame, batches: DataFrame,
) -> DataFrame:
    """Items joined with step, source, object, log, errors, column mapping and batch.

    Log, error and mapping rows of an item multiply with each other. Since only keys are shown, each
    of the three is first reduced to its distinct keys with a count, and the product of the counts
    comes as ``n_rows``; ``expand_rows`` writes the repeated rows out.
    """
    audit = log.groupBy("batch_id", ITEM, F.col("source_id").alias("log_source_id"), F.col("job_id").alias("log_job_id")).agg(
        F.count("*").alias("_log_rows")
    )
    error = errors.groupBy(
        "batch_id", ITEM, F.col("source_id").alias("error_source_id"), F.col("job_id").alias("error_job_id")
    ).agg(F.count("*").alias("_error_rows"))
    mapped = mapping.groupBy(ITEM, F.col("object_id").alias("mapping_object_id")).agg(F.count("*").alias("_mapping_rows"))
    return (
        error.join(shuffled(audit), ["batch_id", ITEM])
        .join(shuffled(items.select(ITEM, "source_id", "job_id", "object_id")), ITEM)
        .join(jobs.select("job_id"), "job_id")
        .join(sources.select("source_id"), "source_id")
        .join(shuffled(objects.select("object_id")), "object_id")
        .join(batches.select("batch_id", "source_id"), ["batch_id", "source_id"])
        .join(shuffled(mapped), ITEM)
        .select(
            ITEM, "source_id", "job_id", "object_id", "batch_id", "error_job_id", "error_source_id",
            "log_source_id", "log_job_id", "mapping_object_id",
            (F.col("_log_rows") * F.col("_error_rows") * F.col("_mapping_rows")).alias("n_rows"),
        )
    )


def expand_rows(counted: DataFrame, count_col: str = "n_rows") -> DataFrame:
    """Every row as often as its count says."""
    return counted.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count_col)))).drop("_i", count_col)


# ---------------------------------------------------------------- notification rows

# The texts of the report bodies.
TABLE_START = "<table cellpadding='2' cellspacing='2' border='1'>"
TABLE_END = "</table>"
SIZE_HEAD = (
    "<tr><th>Table Name</th><th>TimeTaken[HH:MM:SS]</th><th>SizeInGB</th><th>SourceRowCount</th>"
    "<th>TargetRowCount</th><th>Status</th></tr>"
)
QUALITY_HEAD = (
    "<tr><th>Table Name</th><th>TimeTaken[HH:MM:SS]</th><th>SizeInGB</th><th>source_row_count</th>"
    "<th>target_row_count</th><th>rejeted_row_count</th><th>rejected_duplicate_count</th><th>status</th></tr>"
)
COUNT_HEAD = (
    "<tr><th>Table Name</th><th>TimeTaken[HH:MM:SS]</th><th>SourceRowCount</th><th>TargetRowCount</th><th>Status</th></tr>"
)
RECON_HEAD = COUNT_HEAD.replace("</tr>", "<th>ReconMismatchRecondCount</th></tr>")
FAILURE_HEAD = "<tr><th>Table Name</th><th>Isfailed</th><th>ErrorLogId</th></tr>"
DATASET_HEAD = (
    "<tr><th>Id</th><th>Domain Name</th><th>Table Name</th><th>Partition Name</th><th>TimeTaken[HH:MM:SS]</th></tr>"
)
DATASET_FAILURE_HEAD = (
    "<tr><th>Id</th><th>Domain Name</th><th>Table Name</th><th>Partition Name</th><th>Isfailed</th><th>ErrorLogId</th></tr>"
)
STAGE_HEAD = (
    "<tr><th>Execution Layer</th><th colspan='2'>DI </th> <th colspan='3'>DQ </th> <th colspan='2'>RF</th></tr>"
    "<tr><th> Object Name</th><th>Source count </th><th>Target Count</th> <th>Source Count </th><th>Target Count</th>"
    "<th>Rejected Count</th> <th> Source Count</th><th>Target Count</th></tr>"
)
HELLO = "Hi Team, <br/><br/> "
CLOSING = "<br> Thanks, <br> Data Team"
CHECK_ERRORS = "<br> Please check error log table for more deatils <br>"
NO_RECORDS = HELLO + "There is no success records for current execution "
NO_SUCCESS = NO_RECORDS + "<br/><br/>"
STAGE_MISMATCH = HELLO + "Please find data count mismatched table list (DI vs DQ vs RF) for Source : "
STAGE_MATCH = HELLO + "Record count is matching to all tables in DI VS DQ VS RF for Source : "
SOURCE_NAMES = {1: "Oracle", 2: "SAP", 3: "FCCS", 4: "TPH"}


def html_row(*cells: Column | str) -> Column:
    """One table row; a NULL cell empties the whole row. Only '&' stays escaped."""
    shown = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cells]
    text = F.concat(*[p for i, c in enumerate(shown) for p in ([F.lit("</td><td>")] if i else []) + [c]])
    escaped = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.coalesce(F.concat(F.lit("<tr><td>"), escaped, F.lit("</td></tr>")), F.lit("<tr/>"))


def datetime_text(now: dt.datetime) -> str:
    """A moment the way the server prints it by default: 'Jan  3 2024  3:00AM'."""
    hour = now.hour % 12 or 12
    return f"{now:%b} {now.day:>2} {now.year} {hour:>2}:{now.minute:02d}{'AM' if now.hour < 12 else 'PM'}"


def shown(*parts: Column | str) -> Column:
    """Texts and columns joined to one text; NULL wins. Plain strings are literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# The wording of the next four texts, of stage subjects and of the two notices below.


def greeting(status: str, tail: Column | str = "") -> Column:
    return shown(
        "Hi Team, <br/><br/> Please find ", F.col("topic"), f" execution {status} status for sourceid: ",
        F.col("source_id"), " batchid: ", F.col("batch_id"), tail, "<br/><br/>",
    )


def run_subject(status: str, server: str, now: dt.datetime) -> Column:
    at = datetime_text(now)
    return shown(
        "SourceID: ", F.col("source_id"), " ", F.col("topic"), f" execution {status} status, servername: {server} - {at}"
    )


def totals() -> Column:
    return shown(
        "Total table processed = ", F.col("table_count"), "<br/> Total execution time  &nbsp;= ", F.col("total_time"),
        " (HH:MM)<br/><br/>",
    )


def no_failures(tail: Column | str = "") -> Column:
    return shown(
        "Hi Team, <br/><br/> There is no failure records for current execution -- SourceID: ", F.col("source_id"),
        " , BatchID: ", F.col("batch_id"), tail, "<br/><br/>", CLOSING,
    )


def notification(
    groups: DataFrame, pages: DataFrame, routing: DataFrame, *, keys: Sequence[str], status: str,
    subject: Column, head: Column, none: Column, is_none: Column, tail: str = TABLE_END + CLOSING,
) -> DataFrame:
    """Topic, recipients, subject and body per group.

    ``groups`` has the keys, the topic and what the texts name. ``pages`` is ``paged_text`` over the
    detail rows of each group. Recipients come from ``routing`` by topic and status. Groups for
    which ``is_none`` holds get the short body; a group without rows otherwise has no body. Of a text in
    pieces the first has the head and the last the tail.
    """
    recipients = routing.filter(same("status", status)).select(fold("topic").alias("_topic"), "tolist")
    reports = groups.join(pages, list(keys), "left").withColumn("_topic", fold("topic"))
    edges, salt = [head, F.col("body"), tail], list(keys)
    if "n_pages" in pages.columns:
        first, last = F.coalesce("page", F.lit(0)) == 0, F.coalesce(F.col("page") + 1 == F.col("n_pages"), F.lit(True))
        edges, salt = [F.when(first, head).otherwise(""), F.col("body"), F.when(last, F.lit(tail)).otherwise("")], [*keys, "page"]
    # Often all groups share one topic, so the reports are spread by their key.
    return (
        spread_join(reports, recipients, ["_topic"], salt=F.hash(*salt), how="inner", parts=F.lit(tasks_of(reports)))
        .select(
            *keys,
            F.coalesce("page", F.lit(0)).cast("bigint").alias("page"),
            "topic",
            "tolist",
            subject.alias("subject"),
            F.when(is_none, none).otherwise(shown(*edges)).alias("body"),
        )
    )


def success_row(recon_rejects: bool = False) -> Column:
    """The success row of a step: sizes for steps 1 and 3, rejects for step 2, counts for the rest.

    With ``recon_rejects`` step 7 also shows its rejected rows; one without a rejected count is an empty row.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    counted = ("table_name", "time_taken", zero("source_row_count"), zero("target_row_count"), "status")
    common = ("table_name", "time_taken", "size_gb", "source_row_count", "target_row_count", "status")
    rejects = ("rejected_row_count", "rejected_duplicate_count", "status")
    return (
        F.when(F.col("job_id").isin(1, 3), html_row(*common))
        .when(F.col("job_id") == 2, html_row("source_object_name", *common[1:-1], *rejects))
        .when(F.lit(recon_rejects) & (F.col("job_id") == 7), html_row(*counted, "rejected_row_count"))
        .otherwise(html_row(*counted))
    )


def success_head(recon_rejects: bool = False) -> Column:
    head = F.when(F.col("job_id").isin(1, 3), SIZE_HEAD).when(F.col("job_id") == 2, QUALITY_HEAD)
    return head.when(F.lit(recon_rejects) & (F.col("job_id") == 7), RECON_HEAD).otherwise(COUNT_HEAD)


def success_pages(detail: DataFrame, page_rows: int | Pieces | None = None, *, recon_rejects: bool = False) -> DataFrame:
    row = success_row(recon_rejects)
    key = F.concat_ws("|", F.col(ITEM).cast("string"), row)
    return paged_text(detail, RUN, key=key, text=row, page_rows=page_rows)


def success_notification(
    groups: DataFrame, pages: DataFrame, routing: DataFrame, *, server: str, now: dt.datetime, tail: Column | str = "",
    recon_rejects: bool = False,
) -> DataFrame:
    """Success reports; ``groups`` has the run keys, topic, table_count and total_time."""
    none = F.when(
        F.col("job_id") == 2,
        shown(NO_RECORDS, "-- SourceID: ", F.col("source_id"), " , BatchID: ", F.col("batch_id"), "<br/><br/>", CLOSING),
    ).otherwise(NO_SUCCESS + CLOSING)
    return notification(
        groups, pages, routing, keys=RUN, status=SUCCESS, subject=run_subject(SUCCESS, server, now),
        head=shown(greeting(SUCCESS, tail), totals(), TABLE_START, success_head(recon_rejects)),
        none=none, is_none=F.coalesce("table_count", F.lit(0)) == 0,
    )


def failure_pages(detail: DataFrame, page_rows: int | Pieces | None = None) -> DataFrame:
    row = html_row("table_name", "is_failed", "error_log_id")
    return paged_text(detail, RUN, key=F.col(ITEM).cast("string"), text=row, page_rows=page_rows)


def failure_notification(
    groups: DataFrame, pages: DataFrame, routing: DataFrame, *, server: str, now: dt.datetime, tail: Column | str = ""
) -> DataFrame:
    """Failure reports; ``groups`` has the run keys and topic."""
    return notification(
        groups, pages, routing, keys=RUN, status="failed", subject=run_subject("failed", server, now),
        head=shown(greeting("failed", tail), TABLE_START, FAILURE_HEAD), tail=TABLE_END + CHECK_ERRORS + CLOSING,
        none=no_failures(tail), is_none=F.col("body").isNull(),
    )


def dataset_pages(detail: DataFrame, *, failed: bool, page_rows: int | Pieces | None = None) -> DataFrame:
    last = ("is_failed", "error_log_id") if failed else ("time_taken",)
    row = html_row("id", "domain_name", "table_name", "partition_name", *last)
    return paged_text(detail, ["batch_id"], key=F.concat_ws("|", "id", row), text=row, page_rows=page_rows)


def dataset_notification(
    groups: DataFrame, pages: DataFrame, routing: DataFrame, *, failed: bool, server: str, now: dt.datetime
) -> DataFrame:
    """Reports of dataset batches; ``groups`` has batch_id, source_id, topic and, for successes, the totals."""
    status = "failed" if failed else SUCCESS
    if failed:
        head, tail = shown(greeting(status), TABLE_START, DATASET_FAILURE_HEAD), TABLE_END + CHECK_ERRORS + CLOSING
        none, is_none = no_failures(), F.col("body").isNull()
    else:
        head, tail = shown(greeting(status), totals(), TABLE_START, DATASET_HEAD), TABLE_END + CLOSING
        none, is_none = F.lit(NO_SUCCESS + CLOSING), F.coalesce("table_count", F.lit(0)) == 0
    return notification(
        groups, pages, routing, keys=["batch_id"], status=status, subject=run_subject(status, server, now),
        head=head, tail=tail, none=none, is_none=is_none,
    )


def stage_pages(mismatched: DataFrame, page_rows: int | Pieces | None = None) -> DataFrame:
    row = html_row(
        "table_name", "raw_source_rows", "raw_target_rows", "dq_source_rows", "dq_target_rows", "dq_rejected_rows",
        "refined_source_rows", "refined_target_rows",
    )
    key = F.concat_ws("|", "object_id", row)
    return paged_text(mismatched, ["batch_id", "source_id"], key=key, text=row, page_rows=page_rows)


def stage_notification(
    verdict: DataFrame, pages: DataFrame, routing: DataFrame, *, topic: str, status: str, server: str, now: dt.datetime
) -> DataFrame:
    """Count comparison reports per batch and source; sources without a known name have no body."""
    names = F.create_map(*[F.lit(x) for pair in SOURCE_NAMES.items() for x in pair])
    groups = verdict.withColumns({"topic": F.lit(topic), "_name": names[F.col("source_id").cast("int")]})
    place = shown(F.col("_name"), " and  Batchid: ", F.col("batch_id"), "<br/><br/>")
    state = F.when(F.col("tablecount") == 0, " DI vs DQ vs RF- count matched").otherwise(" DI vs DQ vs RF- count mismatched")
    return notification(
        groups, pages, routing, keys=["batch_id", "source_id"], status=status,
        subject=shown("SourceID: ", F.col("source_id"), state, f", servername: {server} - {datetime_text(now)}"),
        head=shown(STAGE_MISMATCH, place, TABLE_START, STAGE_HEAD),
        none=shown(STAGE_MATCH, place, CLOSING), is_none=F.col("tablecount") == 0,
    )


def layer_pages(compared: DataFrame, entity: str, measure: str, page_rows: int | Pieces | None = None) -> DataFrame:
    """Table rows of one measure of ``layer_reconcile``."""
    row = html_row(entity, *[f"{measure}_{c}" for c in ("rpt", "certified", "refined", "match")])
    rows = compared.withColumn("measure", F.lit(measure))
    return paged_text(rows, ["measure"], key=F.col(entity).cast("string"), text=row, page_rows=page_rows)


def plain_notice(routing: DataFrame, *, topic: str, status: str, subject: str, body: str) -> DataFrame:
    """A notice without detail rows to the recipients of a topic and status."""
    chosen = routing.filter(same("topic", topic) & same("status", status))
    return chosen.select("topic", "tolist", F.lit(subject).alias("subject"), F.lit(body).alias("body"))


def failed_run_notice(routing: DataFrame, *, topic: str, status: str, source_id: int, server: str, now: dt.datetime) -> DataFrame:
    """'Pipeline failed' for a source."""
    subject = f"{topic} execution {status} status, servername: {server} - {datetime_text(now)}"
    body = f"{HELLO}Pipeline failed for SourceID: {source_id} <br/><br/>{CLOSING}"
    return plain_notice(routing, topic=topic, status=status, subject=subject, body=body)


def deleted_files_notice(routing: DataFrame, *, topic: str, status: str, deleted: int, server: str, now: dt.datetime) -> DataFrame:
    """How many delivered files were deleted after loading."""
    subject = f"{topic} execution {status} status, servername: {server} - {datetime_text(now)}"
    body = f"{HELLO}Please find {topic} execution {status} status  FilesDeleted: {deleted}<br/><br/>"
    return plain_notice(routing, topic=topic, status=status, subject=subject, body=body)


# ---------------------------------------------------------------- names and files


def unknown_names(names: DataFrame, known: DataFrame, col: str) -> DataFrame:
    """Distinct given names (first column of ``names``) that are not among the known ones."""
    given = names.select(F.col(names.columns[0]).alias("name")).withColumn("_key", fold("name"))
    keys = known.select(fold(col).alias("_key")).distinct()
    return given.join(keys, "_key", "left_anti").groupBy("_key").agg(F.min("name").alias("name")).select("name")


def name_check(names: DataFrame, known: DataFrame, col: str) -> DataFrame:
    """Names given (repeats count) against distinct known names among them, in one row."""
    given = names.select(fold(names.columns[0]).alias("_key"))
    found = known.select(fold(col).alias("_key")).distinct().join(given.distinct(), "_key", "left_semi")
    counts = given.agg(F.count("*").alias("given"))
    return counts.withColumn("known", found.agg(F.count("*")).scalar()).withColumn("valid", F.col("given") == F.col("known"))


# Subjects and bodies of the file arrival verdicts.
ARRIVAL = {
    "name issue": ("FCCS File Name issue ", None),
    "not received": (
        "FCCS Files not received ",
        "Hi Team, <br/><br/> We have not received all the FCCS Files for previous month yet. Please send an email to FCCS team and check. ",
    ),
    "validated": ("FCCS Files received and validated", "Hi Team, <br/><br/> FCCS main pipeline executed"),
}
ARRIVAL_NAMES = (
    "Hi Team, <br/><br/> Following FCCS file(s) Name doesn`t match with metadata: <br/><br/> ",
    "<br/><br/> Please send an email to FCCS team and get it corrected in outbound folder. ",
)
ARRIVAL_CLOSING = "<br><br> Thanks, <br> Data Team"


def file_arrival(expected: DataFrame, arrived: DataFrame) -> DataFrame:
    """Expected and arrived file names side by side: 'ok', 'missing' or 'unexpected'."""
    side = lambda df, tag: df.select(F.col(df.columns[0]).alias("filename")).groupBy(fold("filename").alias("_key")).agg(
        F.min("filename").alias(tag)
    )
    state = F.when(F.col("_arrived").isNull(), "missing").when(F.col("_expected").isNull(), "unexpected").otherwise("ok")
    return (
        side(expected, "_expected")
        .join(side(arrived, "_arrived"), "_key", "full_outer")
        .select(F.coalesce("_expected", "_arrived").alias("filename"), state.alias("state"))
    )


def arrival_verdict(files: DataFrame) -> DataFrame:
    """Counts by state, and which of the three messages they lead to."""
    n = lambda s: F.count(F.when(F.col("state") == s, 1))
    counts = files.agg(n("ok").alias("ok"), n("missing").alias("missing"), n("unexpected").alias("unexpected"))
    arrived_all = F.col("ok") + F.col("unexpected") >= F.col("ok") + F.col("missing")
    verdict = F.when(arrived_all & (F.col("unexpected") > 0), "name issue").when(~arrived_all, "not received").otherwise("validated")
    subjects = F.create_map(*[F.lit(x) for k, v in ARRIVAL.items() for x in (k, v[0])])
    return counts.withColumn("verdict", verdict).withColumn("subject", subjects[F.col("verdict")])


def arrival_message(files: DataFrame, page_rows: int | Pieces | None = None) -> DataFrame:
    """The verdict's message, with the unexpected names."""
    verdict = arrival_verdict(files)
    fixed = F.create_map(*[F.lit(x) for k, (_, text) in ARRIVAL.items() if text for x in (k, text + ARRIVAL_CLOSING)])
    plain = verdict.filter("verdict <> 'name issue'").select(
        "verdict", "subject", F.lit(0).cast("bigint").alias("page"), fixed[F.col("verdict")].alias("body")
    )
    bad = files.filter("state = 'unexpected'").withColumn("state", F.lit("name issue"))
    pages = paged_text(bad, ["state"], key=F.col("filename"), text=F.col("filename"), page_rows=page_rows, sep=", ")
    listed = pages.filter(verdict.select("verdict").scalar() == "name issue").select(
        F.col("state").alias("verdict"),
        F.lit(ARRIVAL["name issue"][0]).alias("subject"),
        "page",
        F.concat(F.lit(ARRIVAL_NAMES[0]), "body", F.lit(ARRIVAL_NAMES[1] + ARRIVAL_CLOSING)).alias("body"),
    )
    return plain.unionByName(listed)
