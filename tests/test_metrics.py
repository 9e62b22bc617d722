"""Exact grouped ROC-AUC against brute-force pair counting."""

import random

import pytest

from chunkwise.operators.metrics import mean_auc, roc_auc


def _brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_grouped_auc_matches_pair_counting(spark):
    rnd = random.Random(7)
    data = []
    for g in range(3):
        for i in range(120):
            score = rnd.choice([0.1, 0.2, 0.5, 0.5, 0.9]) if g == 1 else round(rnd.random(), 2)
            y = 1 if rnd.random() < (0.3 + 0.4 * score) else 0
            data.append((g, i, score, y))
    data += [(3, i, 0.5, 1) for i in range(5)]        # one class only -> null
    df = spark.createDataFrame(data, "g int, id int, score double, y int")
    got = {r.g: r.auc for r in roc_auc(df, "score", "y", "id", group="g").collect()}
    for g in range(4):
        want = _brute([(s, y) for gg, _, s, y in data if gg == g])
        if want is None:
            assert got[g] is None
        else:
            assert abs(got[g] - want) < 1e-12
    m = mean_auc(roc_auc(df, "score", "y", "id", group="g")).first()
    assert m.n_groups == 3


def test_auc_agrees_with_binary_classification_evaluator(spark):
    """Cross-check with Spark ML's evaluator where it is exact (few distinct
    scores, fewer than its bins)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    rows = [(i, float(rnd.choice([0.1, 0.3, 0.3, 0.6, 0.8, 0.95])), 0) for i in range(400)]
    rows = [(i, s, 1 if rnd.random() < s else 0) for i, s, _ in rows]
    df = spark.createDataFrame(rows, "id int, score double, y int")
    ours = roc_auc(df, "score", "y", "id").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC")
    theirs = ev.evaluate(df.select("score", F.col("y").cast("double").alias("label")))
    assert abs(ours - theirs) < 1e-9
    assert abs(ours - _brute([(s, y) for _, s, y in rows])) < 1e-12


def test_event_body_keeps_nulls(spark):
    from pyspark.sql import functions as F
    from chunkwise.sources import build_events
    ev = build_events(spark.range(1), {"data": F.lit(None).cast("string")}, "q", "r1")
    assert '"data":null' in ev.first().value


def test_null_groups_and_labels(spark):
    df = spark.createDataFrame([(None, 1, 0.9, 1), (None, 2, 0.1, 0), (1, 3, 0.5, None),
                                (1, 4, 0.2, 0), (1, 5, 0.8, 1)], "g int, id int, s double, y int")
    got = {r.g: r.auc for r in roc_auc(df, "s", "y", "id", group="g", nulls="exclude").collect()}
    assert got == {None: 1.0, 1: 1.0}
    with pytest.raises(Exception, match="no score or no label"):
        roc_auc(df, "s", "y", "id", group="g").collect()
    from chunkwise.operators.split import stratified_folds
    f = stratified_folds(df, "y", "id", 2, 42)
    assert f.count() == 5 and f.filter("y IS NULL").count() == 1


def test_hash_split_is_deterministic_and_proportional(spark):
    from pyspark.sql import functions as F
    from chunkwise.operators.split import hash_split
    df = spark.range(20000).select(F.col("id").alias("doc_id"),
                                   (F.col("id") % 7 == 0).cast("int").alias("y"))
    a, b = hash_split(df, "doc_id", 0.2, 42), hash_split(df, "doc_id", 0.2, 42)
    assert a.exceptAll(b).count() == 0
    for r in a.groupBy("y").agg(F.avg((F.col("split") == "test").cast("double")).alias("f")).collect():
        assert abs(r.f - 0.2) < 0.03


def test_folds_partition_the_train_split(spark):
    """Folds of the train split are disjoint, cover it exactly, and each
    class is spread evenly over the folds; ceil(n * 0.2) rows are held out, each
    class less than one row from its share."""
    import math
    from pyspark.sql import functions as F
    from chunkwise.operators.split import stratified_folds, stratified_split
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    split = stratified_split(lab, "quality", "doc_id", 0.2, 42)
    sizes = {r.quality: r.n for r in lab.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    tests = {r.quality: r.n for r in split.filter("split = 'test'").groupBy("quality")
             .agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    assert sum(tests.values()) == math.ceil(total * 0.2)
    assert all(abs(tests[q] - n * math.ceil(total * 0.2) / total) < 1 for q, n in sizes.items())
    train = split.filter("split = 'train'").drop("split")
    folds = stratified_folds(train, "quality", "doc_id", 5, 42)
    assert folds.count() == train.count() == folds.select("doc_id").distinct().count()
    assert sorted(r.doc_id for r in folds.collect()) == sorted(r.doc_id for r in train.collect())
    per = folds.groupBy("quality", "fold").count().collect()
    for q in sizes:
        counts = [r["count"] for r in per if r.quality == q]
        assert max(counts) - min(counts) <= 1


def test_quotas_go_to_the_largest_remainders(spark):
    from pyspark.sql import functions as F
    from chunkwise.operators.split import holdout_quotas
    sizes = {"a": 7, "b": 7, "c": 1, None: 6}                 # 21 rows, ceil(4.2) = 5 held out
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "_cw_t string, _cw_n long")
    got = {r[0]: r[1] for r in holdout_quotas(df, 0.2).select("_cw_t", "_cw_quota").collect()}
    # shares 1.67, 1.67, 0.24, 1.43: two rows are left over for a and b
    assert got == {"a": 2, "b": 2, "c": 0, None: 1}
    big = spark.createDataFrame([("a", 6 * 10 ** 10), ("b", 4 * 10 ** 10)], "_cw_t string, _cw_n long")
    assert holdout_quotas(big, 0.2).agg(F.sum("_cw_quota")).first()[0] == 2 * 10 ** 10
