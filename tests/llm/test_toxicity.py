import random

import pytest

from tidemark.llm import toxicity


@pytest.fixture(scope="module")
def corpus(prose):
    rnd = random.Random(9)
    bad = ["vilewordone", "nastytwo", "meanthree", "foulfour"]
    docs, labels = [], []
    for i in range(900):
        words, y = prose(rnd.randint(5, 200), i).split(), int(i % 8 == 0)
        for _ in range(rnd.randint(1, 5) if y else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", "s", "ly", "."]))
        docs.append((i, " ".join(words)))
        labels.append((i, y))
    return docs, labels


def test_held_out_accuracy(spark, make_docs, corpus):
    docs, rows = corpus
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    frame = make_docs(docs)
    model = toxicity.train(frame, labels.filter(~toxicity.held_out()))
    got = toxicity.score(frame, model).withColumn("held_out", toxicity.held_out()).toPandas()
    got["toxic"] = [y for _, y in rows]
    held = got[got.held_out]
    assert 200 < len(held) < 400
    assert held.predicted[held.toxic == 1].mean() > 0.95
    assert held.predicted[held.toxic == 0].mean() < 0.01
    assert got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert list(got.columns).count("score") == 1
    assert model.count() < 5000  # L1 keeps few coordinates


def test_reruns_agree_and_bound_holds(spark, make_docs, corpus):
    docs, rows = corpus
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    models = [sorted(map(tuple, toxicity.train(make_docs(docs), labels.repartition(n), max_rows=300).collect()))
              for n in (1, 5)]
    assert models[0] == models[1]


def test_odd_rows(spark, make_docs, corpus):
    docs, rows = corpus
    labels = spark.createDataFrame(rows + [(None, 1), (3, None), (4, 7), (0, 0), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.train(make_docs([*docs, (None, "null id"), (5, "twice")]), labels)
    odd = make_docs([(1, None), (2, ""), (3, " \n"), (None, "vilewordone nastytwo foulfour"),
                     (4, "clean " * 200_000 + "vilewordone nastytwo meanthree foulfour")])
    got = {r.doc_id: r for r in toxicity.score(odd, model).collect()}
    assert got[1].score == got[2].score == got[3].score < 0.7
    assert got[None].predicted == 1 and got[4].predicted == 1  # the end of a long text counts
    assert toxicity.score(make_docs([]), model).count() == 0


def test_text_ids_learn_the_same_model(spark, make_docs, corpus):
    docs, rows = corpus
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    as_text = lambda df: df.withColumn("doc_id", df.doc_id.cast("string"))
    frame = make_docs(docs)
    models = [sorted(map(tuple, toxicity.train(f(frame), f(labels)).collect())) for f in (lambda x: x, as_text)]
    assert models[0] == models[1] and len(models[0]) > 1


def test_no_labels(spark, make_docs):
    model = toxicity.train(make_docs([(1, "a")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(make_docs([(1, "a")]), model).first().predicted == 0
