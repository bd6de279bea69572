"""Plans and results under the conditions of a large cluster: no broadcasts, hot keys."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import gates, joins, quality, recon, report
from loadkeeper.operators.joins import not_in, paged_text


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def hot_log(spark):
    """A log in which one item has a third of all rows."""
    return spark.range(30_000).select(
        (F.col("id") % 3 + 1).alias("batch_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 211).cast("bigint").alias("job_object_id"),
        (F.col("id") % 1 + 1).alias("source_id"),
        F.when(F.col("id") % 2 == 0, "success").otherwise("failed").alias("status"),
        (F.col("id") % 10).cast("int").alias("source_row_count"),
        (F.col("id") % 10).cast("int").alias("target_row_count"),
        F.lit(0).alias("rejected_duplicate_count"),
    )


@pytest.fixture
def many_items(spark, tmp_path):
    items = spark.range(211).select(
        F.col("id").alias("job_object_id"), (F.col("id") % 1 + 1).alias("source_id"), (F.col("id") % 3 + 1).cast("int").alias("job_id"),
        (F.col("id") % 70).alias("object_id"), F.lit(1).alias("enabled"),
        F.concat(F.lit("n"), (F.col("id") % 40).cast("string")).alias("source_object_name"),
        F.when(F.col("id") % 3 == 0, "n1").otherwise("n1,n2,n1").alias("dependent_table_list"),
    )
    items.write.parquet(str(tmp_path / "items"))
    return spark.read.parquet(str(tmp_path / "items"))


def test_no_broadcast_join_is_needed(no_broadcast, hot_log, many_items):
    runs = hot_log.select("batch_id", "source_id").distinct()
    done = gates.succeeded(hot_log, runs)
    asked = many_items.join(runs, "source_id")
    state = gates.list_gate_state(asked, many_items, done, runs, name_col="source_object_name", jobs=(1, 2, 3))
    plan = final_plan(state)
    assert "Broadcast" not in plan and "Cartesian" not in plan

    names = {r["job_object_id"]: (r["source_object_name"], r["dependent_table_list"]) for r in many_items.collect()}
    ok = defaultdict(set)
    for r in hot_log.filter("status = 'success'").distinct().collect():
        ok[r["batch_id"]].add(r["job_object_id"])
    for r in state.collect():
        listed = r["dependent_table_list"].split(",")
        met = [i for i in ok[r["batch_id"]] if i in names and names[i][0] in listed]
        assert (r["expected_count"], r["met_count"]) == (len(listed), len(met))


def test_the_log_is_reduced_before_it_moves(no_broadcast, hot_log, many_items):
    compared = recon.stage_compare(hot_log, many_items, many_items.select("object_id").distinct().withColumn("table_name", F.lit("t")))
    plan = final_plan(compared)
    assert len(re.findall(r"\bRange \(0, 30000", plan)) == 1  # read once, the other layers reuse its shuffle
    assert plan.count("ReusedExchange") >= 2


def test_not_in_with_a_hot_group(no_broadcast, spark):
    left = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), F.col("id").alias("k"))
    right = spark.range(0, 9_000, 7).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), F.col("id").alias("k"))
    right = right.unionByName(spark.range(1).select(F.lit(11).cast("bigint").alias("g"), F.lit(None).cast("bigint").alias("k")))
    kept = not_in(left, right, "k", ["g"])
    assert "Broadcast" not in final_plan(kept)
    present = {(r["g"], r["k"]) for r in right.collect()}
    want = [(r["g"], r["k"]) for r in left.collect() if (r["g"], r["k"]) not in present and r["g"] != 11]
    assert sorted((r["g"], r["k"]) for r in kept.collect()) == sorted(want)


def test_pages_of_a_hot_group(no_broadcast, spark):
    rows = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), F.col("id").cast("string").alias("t"))
    pages = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=100, sep=",").collect()
    assert max(p["n_rows"] for p in pages) < 200
    assert sorted(int(x) for p in pages for x in p["body"].split(",")) == list(range(6_000))


def test_pages_of_equal_rows(no_broadcast, spark):
    rows = spark.range(20_000).select(F.lit(1).alias("g"), F.lit("same").alias("t"))
    pages = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=100, sep=",").collect()
    assert max(p["n_rows"] for p in pages) == 100 and sum(p["n_rows"] for p in pages) == 20_000
    (whole,) = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), sep=",").collect()
    assert whole["n_rows"] == 20_000 and whole["body"] == ",".join(["same"] * 20_000) and whole["page"] == 0


def test_duplicates_of_a_hot_key(no_broadcast, spark):
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), (F.col("id") % 100).alias("o"), (F.col("id") % 7).alias("v")
    )
    kept = {r["k"]: (r["o"], r["v"], r["n_rows"]) for r in quality.keep_first(rows, ["k"], ["o"]).collect()}
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r["k"]].append((r["o"], r["v"]))
    assert kept == {k: (*min(v), len(v)) for k, v in groups.items()}
    rejected = Counter()
    for r in quality.rejected_duplicates(rows, ["k"], ["o"]).collect():
        rejected[r["k"], r["o"], r["v"]] += r["copies"]
    want = Counter()
    for k, v in groups.items():
        want.update((k, *x) for x in sorted(v)[1:])
    assert rejected == want


def test_failures_read_the_log_once(no_broadcast, hot_log, many_items):
    log = hot_log.withColumn("job_id", (F.col("job_object_id") % 3 + 1).cast("int"))
    errors = log.filter("status = 'failed'").select(
        "batch_id", "job_object_id", "source_id", "job_id", F.monotonically_increasing_id().alias("error_log_id"),
        F.lit(None).cast("timestamp_ntz").alias("log_date"),
    )
    items = many_items.withColumns({"target_object_name": F.lit("t"), "execution_sequence": F.lit(1)})
    objects = many_items.select("object_id").distinct().withColumn("table_name", F.lit("t"))
    detail = report.failure_detail(items, objects, log, errors.limit(0), log.select("batch_id", "source_id").distinct())
    done = {(r["batch_id"], r["job_object_id"]) for r in log.filter("status = 'success'").distinct().collect()}
    seen = {(r["batch_id"], r["job_object_id"]) for r in log.distinct().collect()}
    want = {(b, i, "Failed" if (b, i) in seen else "Skipped") for b in (1, 2, 3) for i in range(211) if (b, i) not in done}
    assert len(re.findall(r"Range \(0, 30000", final_plan(detail))) == 2  # the log once, beside the runs of this test
    assert {(r["batch_id"], r["job_object_id"], r["is_failed"]) for r in detail.collect()} == want


def spread_of(df):
    """Rows by (key, number of its part), as a join over them is shuffled."""
    return Counter((r["g"], r["_salt"]) for r in df.collect())


def test_frequent_keys_are_split_by_their_measured_share(spark, monkeypatch):
    monkeypatch.setattr(joins, "FEW_TASKS", 0)
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 10 == 1, -2).otherwise(F.col("id")).alias("g"), "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks in (8, 200, 1000):  # the same share asks for more parts on a larger cluster
            spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
            parts = joins.parts_of(rows, ["g"])
            counts = {r["g"]: r["n"] for r in rows.select("g", parts.alias("n")).distinct().collect()}
            fair = joins.SHARE * 30_000 / tasks
            assert counts[-1] == -(-10_000 // fair) and counts[-2] == -(-2_000 // fair) and set(counts.values()) == {1, counts[-1], counts[-2]}
            groups = rows.select("g").distinct().withColumn("v", F.col("g") * 2)
            joined = joins.spread_join(rows, groups, ["g"], salt=F.hash("id"))
            assert joined.count() == 30_000 and joined.filter("v <> g * 2").isEmpty()
            sizes = spread_of(rows.withColumn("_salt", F.pmod(F.hash("id"), parts)))
            assert max(sizes.values()) < 1.6 * fair + 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_frequent_keys_of_no_rows_and_null_keys(spark, table, monkeypatch):
    monkeypatch.setattr(joins, "FEW_TASKS", 0)
    rows = table("g int, id int", (None, 1), (None, 2), (1, 3))
    for some in (rows, rows.limit(0)):
        joined = joins.spread_join(some, table("g int, v int", (1, 5), (None, 6)), ["g"], salt=F.hash("id"))
        assert sorted((r["id"], r["v"]) for r in joined.collect()) == ([(1, None), (2, None), (3, 5)] if some is rows else [])


def test_not_in_spreads_rows_without_a_key(no_broadcast, table):
    left = table("g int, k int, b int", *[(1, None, b) for b in range(9)], (2, None, 1), (1, 5, 1), (1, 6, 1))
    right = table("g int, k int", (1, 5))
    assert sorted(map(tuple, not_in(left, right, "k", ["g"], spread=["b"]).collect()), key=repr) == [(1, 6, 1), (2, None, 1)]


def test_pieces_of_a_hot_group(no_broadcast, spark):
    """A third of all rows in one group: its pieces are as large as any others, and the rows lie evenly over the tasks."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50 + 1).alias("g"),
        F.format_string("%05d", F.col("id") * 7919 % 12_000 - F.col("id") % 2).alias("t"),
    )
    pieces = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=joins.Pieces(64), sep=",").collect()
    whole = {r["g"]: r["body"] for r in paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), sep=",").collect()}
    found = defaultdict(list)
    for r in sorted(pieces, key=lambda r: r["page"]):
        found[r["g"]].append(r)
    assert {g: ",".join(r["body"] for r in rs) for g, rs in found.items()} == whole and None in whole
    for rs in found.values():
        assert [r["page"] for r in rs] == list(range(len(rs))) and all(r["n_pages"] == len(rs) for r in rs)
        assert all(r["n_rows"] == 64 for r in rs[:-1]) and 0 < rs[-1]["n_rows"] <= 64
    sizes = Counter(r["p"] for r in joins.placed(rows, ["g"], ["t"]).select(F.spark_partition_id().alias("p")).collect())
    assert max(sizes.values()) < 2 * 12_000 / len(sizes)


def test_pieces_of_equal_rows_and_of_none(spark, table):
    rows = spark.range(1_000).select(F.lit("a").alias("g"), F.lit("same").alias("t"))
    pieces = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=joins.Pieces(300)).collect()
    assert sorted((r["page"], r["n_rows"], r["n_pages"]) for r in pieces) == [(0, 300, 4), (1, 300, 4), (2, 300, 4), (3, 100, 4)]
    assert paged_text(rows.limit(0), ["g"], key=F.col("t"), text=F.col("t"), page_rows=joins.Pieces(3)).collect() == []
