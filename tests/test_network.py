import numpy as np
from pyspark.sql import functions as F

from recspark.operators import network as nw
from recspark.operators import ranking as rk


def table(spark, n=1500):
    """Columns of single and double precision over three partitions, none of whose lengths is a multiple of a block's."""
    r = np.random.default_rng(0)
    x = r.normal(size=(n, 6)) * [1, 2, 3, 4, 1000, 1] + [0, 0, 1, 5, 200, 7]
    x[:, 0], x[:, 5] = x[:, 0].astype("f4"), 3.0
    y = np.sin(x[:, 1]) + x[:, 0] * x[:, 2] / 3 + r.normal(size=n) > 0
    from pyspark.ml.functions import array_to_vector

    rows = spark.createDataFrame([([float(v) for v in a], float(b)) for a, b in zip(x, y)], "f array<double>, label double")
    return rows.repartition(3).select(array_to_vector("f").alias("features"), "label")


def test_network_equals_mllibs(spark):
    """Same start, loss, weights of rows and steps: the weights of MLlib's trainer, and one reading of the rows."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler

    rows = table(spark).persist()
    scaler = StandardScaler(inputCol="features", outputCol="_scaled", withMean=True, withStd=True).fit(rows)
    want = MultilayerPerceptronClassifier(featuresCol="_scaled", labelCol="label", layers=[6, 8, 5, 2], maxIter=25, seed=42).fit(scaler.transform(rows))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    from pyspark.ml.functions import array_to_vector, vector_to_array

    told = rows.select(vector_to_array("features").alias("f"), "label").mapInArrow(count, "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    got_scaler, got = rk.fit_mlp(told, 6, layers=(8, 5), max_iter=25)
    assert np.abs(got.weights.toArray() - want.weights.toArray()).max() < 1e-6 * np.abs(want.weights.toArray()).max()
    assert np.allclose(got_scaler.mean.toArray(), scaler.mean.toArray(), rtol=1e-12) and np.allclose(got_scaler.std.toArray(), scaler.std.toArray(), rtol=1e-12)
    assert read.value == rows.count()  # MLlib's trainer kept a second, stacked copy and read the first three times
    rows.unpersist()


def test_packed_rows_are_whole(spark):
    rows = table(spark, 9000).repartition(1).persist()
    from pyspark.ml.functions import vector_to_array

    packed = rows.select(vector_to_array("features"), F.col("label")).mapInArrow(nw.pack, nw.PACKED)
    got = packed.collect()
    assert [(r["n"], r["tail"]) for r in got] == [(4096, 0), (4096, 0), (808, 808 % 128)]
    assert (np.concatenate([nw.unpack(r.asDict()) for r in got]) == np.array([r["features"].toArray() for r in rows.collect()])).all()
    assert all(list(np.frombuffer(r["single"], dtype=bool)) == [True, False, False, False, False, True] for r in got)
    rows.unpersist()


def test_a_flat_loss_ends_at_once():
    seen = []
    assert (nw.minimise(lambda x: seen.append(1) or (1.0, np.zeros(3)), np.ones(3), 50) == 1).all() and len(seen) == 1
