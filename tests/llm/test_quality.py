"""Held-out accuracy, sums against plain counting, and texts at the edges."""

import random

import numpy as np
from pyspark.sql import functions as F

from prospectra.llm import quality

SF_DIR = "/root/testdata/sf0.01"


def test_context_sums_against_counting(spark):
    rng = random.Random(1)
    texts = [None, "", "a"] + [" ".join(rng.choices(["a", "bb", "ccc", "Dd", "$$"], k=rng.randint(1, 30))) for _ in range(50)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(40)
    index, expected, rows = quality.index_vectors(), np.zeros((quality.ROWS, quality.DIMENSIONS), np.int64), quality._Rows()
    for text in texts:
        own = [r for part in quality._portions((text or "").encode(), rows) for r in part.tolist()]
        for i, row in enumerate(own):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if i != j:
                    expected[row] += index[own[j]]
    assert (quality.context_sums(docs) == expected).all()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model).select("row.doc_id", "score").join(labels, "doc_id")
    aside = scored.where(quality.held_out(F.col("doc_id"))).collect()
    assert len(aside) > 50 and all(0 <= r.score <= 1 for r in aside)
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in aside) / len(aside)
    good = [r.score >= 0.7 for r in aside if r.quality == 1]
    assert right > 0.93 and sum(good) / len(good) > 0.97


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert a.temperature == b.temperature and all((x == y).all() for x, y in zip(a.weights, b.weights))


def test_edges(spark):
    schema = "doc_id long, text string, score string, row int"
    docs = spark.createDataFrame([(1, None, "a", 1), (1, "", "b", 2), (None, "x " * 300_000, None, None)], schema)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert [round(r.score, 6) for r in scored] == [0.5] * 3 and scored[1].row.score == "b"
    empty = spark.createDataFrame([], schema)
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0
    long = ("word " * 10_000 + "é $ ").encode() * 30
    rows = quality._Rows()
    assert sum(map(len, quality._portions(long, rows))) == 30 * 10_002


def test_columns_whose_names_need_quoting(spark):
    schema = "doc_id bigint, text string, `my col` string, score double, `row` int, `a.b` struct<`x y`: int>"
    docs = spark.createDataFrame([(1, "good words", "m", 0.5, 3, (4,)), (2, None, None, None, None, None)], schema)
    model = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    scored = quality.score(docs, model)
    assert scored.columns == ["row", "score"]
    assert [tuple(r) for r in scored.select("row.*").orderBy("doc_id").collect()] == [tuple(r) for r in docs.orderBy("doc_id").collect()]


def test_repeated_ids_give_one_model(spark):
    rows = [(i % 40, f"text {'good' if i % 2 else 'bad'} {i}") for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    models = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(5)
        models.append(quality.fit(docs, labels, epochs=2))
    assert all((a == b).all() for a, b in zip(models[0].weights, models[1].weights, strict=True))
