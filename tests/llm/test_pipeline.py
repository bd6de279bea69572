import pytest

import corpus_pipeline
from loadkeeper.llm import bpe
from loadkeeper.llm.queries import tokenizer
from tests.llm import test_leaks, test_lines, test_simhash
from tests.llm.conftest import FOLDER


@pytest.fixture(scope="module")
def stages(spark, sample, tmp_path_factory):
    """What goes into each stage and comes out of it."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), sample[0], []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, kept))
        docs = kept
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_keep_the_columns(stages, sample):
    for _, kept in stages[:-1]:
        assert kept.columns == sample[0].columns


def test_toxicity_keeps_clean_documents(spark, stages):
    folder = "/root/testdata/sf0.1"  # the smallest sample has too few labels to learn from
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    gone = [toxic for i, toxic in labels.items() if i not in left]
    assert sum(gone) >= 0.9 * len(gone) and sum(gone) >= 0.8 * sum(labels.values())


def test_line_dedup(stages):
    before, after = map(pairs, stages[1])
    gone = test_lines.by_hand(before)
    expected = {}
    for i, t in before:
        left = [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone]
        if any(x.strip() for x in left) or not t.strip():
            expected[i] = "\n".join(left)
    same = sum(expected.get(i) == t for i, t in after)
    assert same >= 0.99 * len(expected) and abs(len(after) - len(expected)) <= 1
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1][1].collect())


def test_one_of_each_group_of_near_duplicates(stages):
    before, after = map(pairs, stages[2])
    assert sorted(i for i, _ in after) == sorted(i for i, _, c in test_simhash.classes(before) if i == c)


def test_no_benchmark_item_stays(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = map(pairs, stages[3])
    leaked = {i for i, _ in test_leaks.by_hand(before, items)}
    assert {i for i, _ in after} == {i for i, _ in before} - leaked


def test_tokens(stages):
    own, texts = bpe.Encoder(*tokenizer()), dict(pairs(stages[4][0]))
    for r in stages[4][1].collect():
        assert r["ids"] == own.ids(texts[r["doc_id"]]) and r["decoded"] == texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"])


def test_a_task_has_one_python_worker_at_a_time(spark, sample):
    plan = corpus_pipeline.tokens(spark, sample[0], FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_run_is_all_stages(spark, stages):
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(r["doc_id"] for r in stages[4][1].collect())


def test_empty_documents(spark, sample):
    docs = sample[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
