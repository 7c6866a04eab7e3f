import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from recspark.llm.crf import Model, fit, forward_backward, held_out, identify, split, train
from recspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    r = np.random.default_rng(0)
    size = np.array([3, 1, 5, 3])
    first = np.cumsum(size) - size
    score, move = r.normal(size=(12, 3)), r.normal(size=(3, 3))
    gamma, expected = forward_backward(score, first, size, move, pairs=True)
    want, pairs = np.zeros((12, 3)), np.zeros((3, 3))
    for i, n in zip(first, size):
        z, node, edge = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(sum(score[i + t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            z += w
            for t, y in enumerate(path):
                node[t, y] += w
            for a, b in zip(path, path[1:]):
                edge[a, b] += w
        want[i:i + n] = node / z
        pairs += edge / z
    assert np.allclose(gamma, want, atol=1e-6) and np.allclose(expected, pairs, atol=1e-6)


def test_labels_switching_words():
    a, b = [f"{p}ung{s}" for p in "abcdefgh" for s in ("en", "er")], [f"{p}que{s}" for p in "abcdefgh" for s in ("os", "as")]
    m = train([" ".join(a[i:] + a[:i]) for i in range(12)] + [" ".join(b[i:] + b[:i]) for i in range(12)], ["x"] * 12 + ["y"] * 12)
    w = split(["zungen kungen mungen tunger lunger zquos kquas lquos mquos pquas"])
    gamma, _ = forward_backward(m.scores(w, np.arange(10)).astype(float), np.array([0]), np.array([10]), m.transition)
    assert [m.labels[k] for k in gamma.argmax(axis=1)] == ["x"] * 5 + ["y"] * 5
    assert m.transition[0, 0] > m.transition[0, 1] and m.transition[1, 1] > m.transition[1, 0]


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_crf_language_id"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) > 0.97


def test_prediction_does_not_depend_on_order_or_batches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(docs.where("not held_out"), train_rows=200)
    again = fit(docs.where("not held_out").repartition(7), train_rows=200)
    assert model.labels == again.labels and np.allclose(model.weight, again.weight)
    one = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in identify(docs, model, ["doc_id"]).collect()}
    two = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in identify(docs.repartition(9), model, ["doc_id"], most_bytes=500, most_words=50).collect()}
    assert one == two


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, k0 string, score int"
    train_rows = [(i, "the and of " * 5, "en", "", 0) for i in range(5)] + [(9 + i, "der die das " * 5, "de", "", 0) for i in range(5)] + [(30, None, "en", "", 0), (31, "x", None, "", 0)]
    model = fit(spark.createDataFrame(train_rows, schema))
    assert model.labels == ["de", "en"]
    odd = [(1, None, None, "", 0), (2, "", None, "", 0), (3, "12 !! \n 3", None, "", 0), (None, "the of", None, "", 0), (4, "the " * 200_000, None, "", 0), (4, "DIE das", None, "", 0), (4, "DIE das", None, "", 0)]
    got = sorted([(r.doc_id, r.lang_pred, r.n_words) for r in identify(spark.createDataFrame(odd, schema), model, ["doc_id"]).collect()], key=str)
    assert got == sorted([(1, "und", 0), (2, "und", 0), (3, "und", 0), (None, "en", 2), (4, "en", 200_000), (4, "de", 2), (4, "de", 2)], key=str)
    empty = spark.createDataFrame([], schema)
    assert identify(empty, model, ["doc_id"]).count() == 0
    none = fit(empty)
    assert isinstance(none, Model) and [r.lang_pred for r in identify(spark.createDataFrame(odd[3:4], schema), none, ["doc_id"]).collect()] == ["und"]


def test_every_language_is_learnt(spark):
    """201 languages, one of which is nearly all rows, and they copies of one text."""
    from recspark.llm.crf import fit, identify

    r = random.Random(8)
    words = {k: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for k in range(201)}
    rows = [(f"l{k}", " ".join(r.choices(words[k], k=12))) for k in range(201) for _ in range(4)]
    rows += [("l0", " ".join(words[0]))] * 3000
    model = fit(spark.createDataFrame(rows, "lang string, text string"), train_rows=402, train_chars=100)
    assert len(model.labels) == 201
    asked = [(k, " ".join(words[k][:8])) for k in (0, 17, 100, 200)]
    got = {x.k: x.lang_pred for x in identify(spark.createDataFrame(asked, "k long, text string"), model, ["k"]).collect()}
    assert got == {k: f"l{k}" for k, _ in asked}
