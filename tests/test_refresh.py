import json

import pytest

from loadkeeper.operators import refresh

CONFIG = """id bigint, datasetid string, table_name string, partition_name string, enabled boolean, job_frequency string,
  maxparallelism string, recalc_consider string, execution_sequence string, domain_id bigint, quarter_name string, groupid string"""
LOG = "batch_id bigint, job_object_id bigint, status string"


def entry(id, ds="d", part=None, enabled=True, freq="D", par="4", recalc="N", seq="1", domain="same", quarter="0", group="g"):
    return (id, ds, f"t{id}", part, enabled, freq, par, recalc, seq, id * 10 if domain == "same" else domain, quarter, group)


def names(df):
    return sorted(r["table_name"] for r in df.collect())


def test_null_domain_needs_an_empty_success_list(table):
    config = table(CONFIG, entry(1), entry(2, domain=None), entry(3))
    assert names(refresh.plan_entries(config, table(LOG), [1])) == ["t1", "t2", "t3"]
    log = table(LOG, (1, 10, "success"), (1, 30, "failed"))
    assert names(refresh.plan_entries(config, log, [1])) == ["t3"]
    assert names(refresh.plan_entries(config, log, [2])) == ["t1", "t2", "t3"]
    assert names(refresh.plan_entries(config, table(LOG, (1, 77, "success")), [1])) == ["t1", "t2", "t3"]


def test_weekly_and_unset_frequency(table):
    config = table(CONFIG, entry(1, "a"), entry(2, "b", freq="w "), entry(3, "c", freq=None), entry(4, "d", enabled=False))
    got = lambda **o: sorted(r["datasetid"] for r in refresh.dataset_list(config, table(LOG), [1], **o).collect())
    assert got(saturday=False) == ["a"]
    assert got(saturday=True) == ["a", "b", "c"]
    assert got(saturday=True, datasets="A,c") == ["a", "c"]


@pytest.mark.parametrize(
    "now, kept", [("2024-01-15 00:00:00", [1, 3, 4, 5, 7]), ("2023-12-31 23:00:00", [1, 3, 4, 6, 7])]
)
def test_rolling_months(table, now, kept):
    config = table(
        CONFIG, entry(1), entry(2, part=""), entry(3, part="2023-12"), entry(4, part="2024-01"), entry(5, part="2024-3"),
        entry(6, part="2023-11"), entry(7, part="2024-02"), entry(8, part="2024-4"),
    )
    assert names(refresh.plan_entries(config, table(LOG), [1], mode="months", now=now)) == [f"t{i}" for i in kept]


def test_open_ended_months(table):
    config = table(CONFIG, entry(1), entry(2, part="2023-11"), entry(3, part="2030-1"))
    kept = config.filter(refresh.from_month("2024-01-15 00:00:00"))
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]


def test_quarters_skip_the_success_filter(table):
    config = table(
        CONFIG, entry(1, quarter="0"), entry(2, quarter="1"), entry(3, quarter="5"), entry(4, quarter=None), entry(5, quarter="2", enabled=False),
        entry(6, quarter="x"),
    )
    log = table(LOG, (1, 10, "success"))
    plan = refresh.plan_entries(config, log, [1], mode="quarters")
    # four distinct enabled quarters ('0', '1', '5', 'x'): numbers 0 to 3
    assert names(plan) == ["t1", "t2"]
    bodies = {r["quarter"]: json.loads(r["final_body"]) for r in refresh.quarter_plan(config, [1]).collect()}
    assert sorted(bodies) == [0, 1, 2]
    assert bodies[2]["objects"] == [] and bodies[0]["objects"] == [{"table": "t1"}]


def test_payload_forms(table):
    config = table(
        CONFIG, entry(1, "a", part="2024-1"), entry(2, "a", part=""), entry(3, "b", par="NA"), entry(4, "c", par=None),
        entry(5, "e", domain=None, group="x"), entry(6, "e", group="y"), entry(7, "e", group="z"),
    )
    got = {r["datasetid"]: r for r in refresh.full_payload(refresh.plan_entries(config, table(LOG), [1]), config).collect()}
    assert json.loads(got["a"]["final_body"]) == {
        "type": "full", "commitMode": "transactional", "maxParallelism": 4, "retryCount": 1,
        "objects": [{"table": "t1", "partition": "2024-1"}, {"table": "t2"}],
    }
    assert json.loads(got["b"]["final_body"]) == {"type": "full", "objects": [{"table": "t3"}]}
    assert json.loads(got["c"]["final_body"])["type"] == "full" and "maxParallelism" not in got["c"]["final_body"]
    assert (got["e"]["job_object_id"], got["e"]["groupid"]) == (60, "y")


def test_large_payloads_are_paged_without_loss(table):
    config = table(CONFIG, *[entry(i) for i in range(300)])
    pages = refresh.full_payload(refresh.plan_entries(config, table(LOG), [1]), config, max_objects=20).collect()
    assert len(pages) > 10
    listed = [o["table"] for p in pages for o in json.loads(p["final_body"])["objects"]]
    assert sorted(listed) == sorted(f"t{i}" for i in range(300))


def test_recalculation(table):
    config = table(CONFIG, entry(1, recalc="y"), entry(1, recalc="Y"), entry(2), entry(3, recalc="Y"))
    row = refresh.calculate_payload(refresh.recalc_entries(config, table(LOG, (1, 30, "success")), [1])).first()
    assert row["final_body_recalc"] == '{"type":"calculate","objects":[{"table":"t1"}]}'


def test_a_dataset_in_two_spellings_is_one(table):
    config = table(CONFIG, entry(1, "Sales"), entry(2, "sales "), entry(3, "SALES", enabled=False), entry(4, "other", recalc="Y"), entry(5, None))
    log = table(LOG)
    found = refresh.dataset_list(config, log, [1], saturday=False).collect()
    assert sorted(str(r["datasetid"]) for r in found) == ["None", "SALES", "other"]
    entries = refresh.plan_entries(config, log, [1])
    asked = table("batch_id bigint, datasetid string, execution_sequence string", (1, "sales", "1"), (1, "Sales ", "1"))
    for rows in (refresh.full_payload(entries, config), refresh.full_payload(entries, config, asked=asked)):
        body = {r["datasetid"]: r["final_body"] for r in rows.collect()}
        assert [o["table"] for o in json.loads(body["SALES"])["objects"]] == ["t1", "t2"]
    twice = table(CONFIG, entry(1, recalc="Y"), tuple("T1 " if v == "t1" else v for v in entry(1, "D", recalc="y")), entry(2, recalc="Y"))
    assert names(refresh.recalc_entries(twice, log, [1])) == ["T1 ", "t2"]
