import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadkeeper.llm import rules
from loadkeeper.llm.queries import QUERIES
from tests.llm.conftest import FOLDER


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    repeated = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(5)}
    seen, again = set(), 0
    for x in lines:
        again += x in seen
        seen.add(x)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": again,
        "n_repeat_words": len(repeated), "n_lines": len(lines), "n_echoes": sum(a == b for a, b in zip(words, words[1:])),
    }


def measured(df):
    return [(r["text"], r["m"].asDict()) for r in df.select("text", rules.measures(F.col("text")).alias("m")).collect()]


def random_texts():
    dice = random.Random(9)
    marks = ["\n", " ", "\t", " ", " ", "é ", "😀 ", "a ", "b ", "the ", "c d e ", "## ", "\r\n", "\x0b"]
    return ["".join(dice.choice(marks) for _ in range(dice.randrange(0, 120))) for _ in range(300)]


def test_counts_against_brute_force(docs):
    df = docs(list(enumerate(random_texts() + [None, "", "\n\n", "a b c d e a b c d e", "x x x x x x x", "q w e r t y"])))
    for text, m in measured(df):
        hand = by_hand(text)
        assert {k: m[k] for k in hand} == hand, text


def test_a_very_long_text(docs):
    text = "\n".join(f"w{i % 30000} is a word of line {i}" for i in range(60_000))
    [(_, m)] = measured(docs([(1, text + "\nw1 is a word of line 1")]))
    assert m["n_words"] == 7 * 60_001 and m["n_dup_lines"] == 1 and m["n_repeat_words"] == by_hand(text + "\nw1 is a word of line 1")["n_repeat_words"]


def verdict(one, text):
    return one(rules.failed(rules.measures(F.lit(text))))


@pytest.mark.parametrize(
    "text, broken",
    [
        ("too short", ["few_words"]),
        ("This is a plain sentence that has all the usual words and nothing odd in it.", []),
        ("a b c d e f g h i j", ["short_words"]),
        ("This ## is ## a line ## with ## the symbols ## of ## a table", ["symbols"]),
        ("NO!! ONE!! SHOUTS!! LIKE!! THIS!! IN!! A!! TEXT!! OF!! ANY!! WORTH!!", ["shouts", "capitals"]),
        (" ".join(f"wort{chr(97 + i)}" for i in range(26)), ["stop_words"]),
        ("the same five words again " * 4, ["repeated_words"]),
        ("the the cat cat is is on on a a mat mat", ["echoes"]),
        ("the line\nthe line\nthe line\nand one other line of some more words", ["repeated_lines"]),
        ("- the one\n- the other\n* the third\n • the fourth and the last of them all", ["bullets"]),
        ("the first line...\nthe next one is cut…  \nthe third is whole, and no more of them", ["cut_lines"]),
    ],
)
def test_every_rule_fires_on_its_case(one, text, broken):
    assert verdict(one, text) == broken


def test_bounds_are_exact(one):
    rule = (rules.Rule("r", "n_symbols", "n_words", most=10),)
    at = lambda n: one(rules.failed(rules.measures(F.lit("# " * n + "w " * (20 - n))), rule))
    assert at(2) == [] and at(3) == ["r"]
    assert one(rules.failed(rules.measures(F.lit("")), (rules.Rule("x", "n_words", "n_lines", least=1, among=1),))) == []


def test_one_projection_without_python(docs):
    plan = docs([(1, "a")]).select(rules.failed(rules.measures(F.col("text"))))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd, nothing):
    for df in (odd, nothing):
        assert len(df.select(rules.failed(rules.measures(F.col("text")))).collect()) == df.count()


def test_junk_goes_and_clean_documents_stay(spark, sample):
    labels = spark.read.parquet(FOLDER.replace("0.001", "0.01") + "/labels.parquet")
    got = QUERIES["op12_quality_rules"](spark, FOLDER.replace("0.001", "0.01")).join(labels, "doc_id").collect()
    clean = [r["kept"] for r in got if r["quality"] == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(clean) >= 0.99 * len(clean) > 200 and sum(junk) <= 0.05 * len(junk)


def test_texts_are_not_looked_up_character_by_character(docs):
    df = docs([(1, "The,the!! THE\x0b(é)\t\\n 😀 der. \r\n  \n##|x")])
    measured_ = df.select(rules.measures(F.col("text")).alias("m"))
    assert "translate(" not in measured_._jdf.queryExecution().optimizedPlan().toString()
    m = measured_.first()["m"]
    assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_shouts"], m["n_capitals"], m["n_stop_words"], m["n_lines"]) == (7, 26, 3, 2, 4, 2, 2)
