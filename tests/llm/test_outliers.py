"""Counts against plain Python, the estimate against numpy, and what is rejected."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from prospectra.llm import outliers


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in outliers.SYMBOLS for c in text), again, len(covered)


def test_counts(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "é ß　z $$ |", "l\nl\n l\n\n\nl"]
    texts += [rng.choice([" ", "\n", "\t"]).join(rng.choices(["a", "b", "cc", "#x", "é"], k=rng.randint(0, 60))) for _ in range(60)]
    texts.append("line one two\n" * 5000)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r.row.doc_id: tuple(r[c] for c in outliers.COUNTS) for r in outliers.document_statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_distance_is_mahalanobis(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(0, 500, (300, 4)) @ rng.normal(0, 1, (4, 4)))
    rows = spark.createDataFrame([("g", *map(float, v)) for v in values], "group string, x1 double, x2 double, x3 double, x4 double")
    estimate = outliers._estimate(rows.groupBy("group").agg(*outliers._sums()), "group")
    got = [r.distance for r in outliers._with(rows, estimate).orderBy("x1", "x2").collect()]
    cov = np.cov(values.T, bias=True) + np.diag([f**2 for f in outliers.FLOORS.values()])
    centred = values - values.mean(axis=0)
    expected = np.einsum("ij,ij->i", centred @ np.linalg.inv(cov), centred)
    order = np.lexsort((values[:, 1], values[:, 0]))
    assert np.allclose(got, expected[order], rtol=1e-6)


def documents(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800)]
    rows = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(rng.randint(6, 30)))
        if i % 10 == 0:
            text = " ".join(word + "$$#" for word in text.split())
        rows.append((i, text, "en" if i % 2 else "de", f"s{i % 3}", 1.0))
    return rows


def test_junk_is_rejected_and_clean_text_kept(spark):
    rows = documents(900, 4) + [(-1, None, None, None, None), (-2, "few words", "en", "s1", 0.0), (5, "a " * 99, "en", "s1", 0.0)]
    schema = "doc_id long, text string, lang string, source string, distance double"
    judged = outliers.judge(spark.createDataFrame(rows, schema).repartition(5), min_group=60).collect()
    assert len(judged) == len(rows)
    for r in judged:
        bad = r.row.doc_id < 0 or r.row.text.startswith("a a ") or "$$#" in r.row.text
        assert r.kept != bad, (r.row.doc_id, r.distance)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_empty_table_and_plan(spark):
    schema = "doc_id long, text string, lang string, source string"
    judged = outliers.judge(spark.createDataFrame([], schema))
    assert judged.count() == 0
    plan = outliers.document_statistics(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert not any(word in plan._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = outliers.judge(docs, columns=["doc_id"]).where("NOT base_failed").select("row.doc_id", "kept")
    good = judged.join(labels.where("quality = 1"), "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.98
