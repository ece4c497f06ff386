import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.queries import op8_quality_rules, table

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = {}
    for at in range(len(words) - 7):
        places.setdefault(tuple(words[at : at + 8]), []).append(at)
    covered = {p for found in places.values() if len(found) > 1 for at in found for p in range(at, at + 8)}
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered))
    return counts + (counts[0] < 20 or 100 * counts[4] > 30 * counts[0],)


@pytest.fixture(scope="module")
def judged(spark):
    return op8_quality_rules(spark, SF_DIR).cache()


def test_counts_equal_brute_force(spark, judged):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    for r in judged.collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), r.doc_id


def test_labels_agree(spark, judged):
    labels = table(spark, SF_DIR, "labels")
    shares = judged.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")
    )
    kept = {r["quality"]: r["kept"] for r in shares.collect()}
    assert kept[1] > 0.99 and kept[0] < 0.1


def test_concentration_ignores_a_third_of_outliers(spark):
    clean = [(i, " ".join(f"wo{(i * 7 + j * 13) % 89}rd" for j in range(60)), "en", "a") for i in range(120)]
    dirty = [(1000 + i, " ".join(f"$$${(i * 3 + j * 5) % 97}###" for j in range(60)), "en", "a") for i in range(50)]
    rows = spark.createDataFrame(clean + dirty, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality.judge(rows).collect()}
    assert all(got[i] for i, *_ in clean) and not any(got[i] for i, *_ in dirty)


def test_no_python_in_the_plan(judged):
    plan = judged._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
