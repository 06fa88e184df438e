import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crivo.operators import encode, forest
from crivo.operators.forest import ForestParams, class_weights, fit_forest, score_forest

PARAMS = ForestParams(num_trees=4, max_depth=4, least_partitions=3)


@pytest.fixture(scope="module")
def signature(features):
    return encode.matrix_signature(features, encode.vocabulary(features))


@pytest.fixture(scope="module")
def model(features, signature):
    return fit_forest(features, signature, PARAMS)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "inadimplente long")
    weights = {r.inadimplente: r.weight for r in class_weights(df).collect()}
    assert weights == {0: 8 / 12, 1: 8 / 4}


def test_unknown_label_raises(spark):
    df = spark.createDataFrame([(0,), (5,)], "inadimplente long")
    with pytest.raises(PySparkException, match="label outside"):
        class_weights(df).collect()


@pytest.mark.parametrize("partitions", [1, 5])
def test_forest_does_not_depend_on_layout(features, signature, model, partitions):
    shuffled = features.orderBy(F.rand(1)).repartition(partitions)
    again = fit_forest(shuffled, signature, PARAMS)
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]


def test_forest_learns(features, signature, model):
    from crivo.operators.metrics import auc

    scored = score_forest(features, model, signature, keep=["inadimplente"])
    assert auc(scored).first().auc > 0.8


def test_scoring_stays_in_the_jvm(features, signature, model):
    scored = score_forest(features, model, signature, keep=["id_contrato"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "Exchange" not in plan and "MapInPandas" not in plan


def test_scoring_keeps_every_row_and_any_column(features, signature, model):
    holes = features.withColumn("renda_anual", F.lit(None).cast("double")).withColumn(
        "regiao", F.lit("nova")
    )
    scored = score_forest(holes, model, signature, keep=["id_contrato", "regiao", "prazo_meses"])
    assert scored.columns == [
        "id_contrato", "regiao", "prazo_meses", "prob", "classe_modelo", "classe_limiar",
    ]
    assert scored.count() == features.count()
    assert scored.where("prob IS NULL OR prob NOT BETWEEN 0 AND 1").isEmpty()


def test_classes_follow_the_probability(features, signature, model):
    scored = score_forest(features, model, signature, keep=[])
    assert scored.where("(prob >= 0.5) <> (classe_limiar = 1)").isEmpty()
    assert scored.where("prob <> 0.5 AND classe_modelo <> classe_limiar").isEmpty()


def test_one_half_is_class_zero_for_the_model_and_one_for_the_threshold(spark):
    """Rows that cannot be told apart: every tree answers the same, and over
    many seeds the model's class is 1 only above one half."""
    df = spark.createDataFrame(
        [(i, 1.0, i % 2) for i in range(4)], "id_contrato long, x double, inadimplente long"
    )
    signature = [encode.SignatureColumn("x", "double")]
    seen = set()
    for seed in range(12):
        model = fit_forest(df, signature, ForestParams(1, 1, seed=seed, least_partitions=1))
        row = score_forest(df, model, signature, keep=[]).first()
        assert (row.classe_modelo, row.classe_limiar) == (row.prob > 0.5, row.prob >= 0.5)
        seen.add(row.prob == 0.5)
        if True in seen:
            return
    pytest.fail("no seed gave one half")


def test_layout_follows_the_rows(features, signature, monkeypatch):
    seen = []
    fit = forest.RandomForestClassifier.fit
    monkeypatch.setattr(
        forest.RandomForestClassifier,
        "fit",
        lambda self, df: (seen.append(df.rdd.getNumPartitions()), fit(self, df))[1],
    )
    fit_forest(features, signature, ForestParams(2, 2, rows_per_partition=100))
    assert seen == [15]


def test_no_class_to_learn_raises(features, signature):
    with pytest.raises(Exception):
        fit_forest(features.limit(0), signature, PARAMS)


def test_node_cache_gives_the_same_forest(features, signature, model):
    cached = ForestParams(num_trees=4, max_depth=4, least_partitions=3, cache_node_ids=True)
    again = fit_forest(features, signature, cached)
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]


def test_registered_queries_fit_the_whole_forests(monkeypatch, spark, small):
    from crivo.operators import forest
    from crivo.plans import lifecycle, queries

    class Asked(Exception):
        pass

    def record(train, signature, params, *more, **options):
        asked.append(params)
        raise Asked

    for module in (queries, lifecycle):
        monkeypatch.setattr(module, "fit_forest", record)
    for name, params in (
        ("train_champion", forest.CHAMPION),
        ("train_challenger", forest.CHALLENGER),
        ("score_proba", forest.CHALLENGER),
        ("score_batch", forest.CHALLENGER),
        ("lifecycle_run", forest.CHAMPION),
    ):
        asked = []
        with pytest.raises(Asked):
            queries.queries()[name](spark, small)
        assert asked == [params], name


def test_fit_is_bounded_by_a_hash_of_the_key(features, signature, monkeypatch):
    seen = []
    fit = forest.RandomForestClassifier.fit
    monkeypatch.setattr(
        forest.RandomForestClassifier,
        "fit",
        lambda self, df: (seen.append({r.id_contrato for r in df.collect()}), fit(self, df))[1],
    )
    bounded = ForestParams(2, 2, least_partitions=2, max_rows=400)
    for rows in (features, features.orderBy(F.rand(3)).repartition(7)):
        fit_forest(rows, signature, bounded)
    assert seen[0] == seen[1] and 300 < len(seen[0]) < 500
    fit_forest(features, signature, ForestParams(2, 2, least_partitions=2, max_rows=1500))
    assert len(seen[2]) == 1500


def test_bounded_fit_measures_like_the_full_one(spark):
    """AUC within 0.03 on contracts that neither fit saw."""
    from crivo.operators.metrics import auc
    from crivo.sources.contracts import feature_table
    from crivo.sources.tables import staged

    rows = staged(feature_table(spark, "/root/testdata/sf0.01"), "features")
    signature = encode.matrix_signature(rows, encode.vocabulary(rows))
    held = F.pmod(F.col("id_contrato"), F.lit(5)) == 0
    found = []
    for bound in (None, 4000):
        model = fit_forest(rows.where(~held), signature, ForestParams(20, 8, max_rows=bound))
        found.append(auc(score_forest(rows.where(held), model, signature, keep=["inadimplente"])).first().auc)
    assert abs(found[0] - found[1]) < 0.03 and min(found) > 0.8


def test_forest_too_large_to_send_raises(features, signature, model, monkeypatch):
    monkeypatch.setattr(forest, "MOST_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        score_forest(features, model, signature, keep=[])


def test_scores_come_from_the_registered_model(spark, small, monkeypatch, tmp_path):
    from crivo.plans import queries

    tiny = ForestParams(3, 3, least_partitions=2)
    monkeypatch.setattr(queries, "CHALLENGER", tiny)
    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path))
    first = queries.queries()["score_proba"](spark, small).orderBy("id_contrato").collect()

    def refuse(*args, **options):
        raise AssertionError("fitted again")

    monkeypatch.setattr(queries, "fit_forest", refuse)
    again = queries.queries()["score_proba"](spark, small).orderBy("id_contrato").collect()
    batch = queries.queries()["score_batch"](spark, small)
    assert first == again and batch.count() == len(first)


@pytest.mark.parametrize("params", [ForestParams(30, 8, least_partitions=2), ForestParams(3, least_partitions=2)])
def test_whole_tables_get_the_answers_of_the_model(features, signature, params):
    """To the last bit, with NULL, NaN, infinity and either zero among the numbers scored."""
    odd = F.element_at(
        F.array(*[F.lit(v).cast("double") for v in (None, "NaN", "Infinity", "-Infinity", "0.0", "-0.0")]),
        (F.col("id_contrato") % 6 + 1).cast("int"),
    )
    some = features.withColumn("renda_anual", F.when(F.col("id_contrato") % 5 == 0, odd).otherwise(F.col("renda_anual")))
    model = fit_forest(features, signature, params)
    keep = ["id_contrato", "regiao", "prazo_meses"]
    one = score_forest(some, model, signature, keep).orderBy("id_contrato").collect()
    whole = score_forest(some, model, signature, keep, whole_table=True)
    assert whole.columns == [*keep, "prob", "classe_modelo", "classe_limiar"]
    assert whole.orderBy("id_contrato").collect() == one


def test_categories_and_more_classes_go_the_model_s_way(spark):
    """Splits by category as well, values that no split knows among them."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    from crivo.operators import trees

    rows = spark.range(600).select(
        (F.xxhash64("id") % 7 + 6).cast("double").alias("c"), (F.xxhash64("id", F.lit(1)) % 50).cast("double").alias("x")
    )
    named = {"ml_attr": {"type": "nominal", "name": "c", "num_vals": 13}}
    rows = rows.withColumn("y", F.pmod(F.col("c") * 5 + F.col("x"), F.lit(3.0))).withMetadata("c", named)
    gather = VectorAssembler(inputCols=["c", "x"], outputCol="features", handleInvalid="keep")
    model = RandomForestClassifier(labelCol="y", numTrees=5, maxDepth=5, seed=1).fit(gather.transform(rows))
    splits = trees.trees_of(model, spark).splits
    assert {k < 0 for _, k, _ in splits} == {True, False}
    wanted = model.transform(gather.transform(rows.unionByName(rows.limit(20).withColumn("c", F.lit(40.0)))))
    wanted = wanted.select("c", "x", F.col("prediction").cast("int").alias("wanted"))
    found = trees.answer(wanted.select("wanted", F.col("c").alias("f0"), F.col("x").alias("f1")), model, ["f0", "f1"])
    assert found.count() == 620 and found.where("wanted <> _class").isEmpty()


def test_a_table_takes_a_fraction_of_the_model_s_time(spark, features, signature, model):
    """300 trees walked as arrays against the model's own walk, on one core's worth of rows."""
    import time

    forest_of_300 = fit_forest(features, signature, forest.CHALLENGER)
    many = features.crossJoin(spark.range(60)).repartition(4).checkpoint()

    def seconds(**options):
        began = time.perf_counter()
        score_forest(many, forest_of_300, signature, ["id_contrato"], **options).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds(whole_table=True)
    assert seconds(whole_table=True) < seconds() * 0.8


def test_all_rows_are_fitted(spark, monkeypatch):
    """More than the 20,000 rows that candidates once were fitted on."""
    assert forest.CHAMPION.max_rows is None and forest.CHALLENGER.max_rows is None
    seen = []
    fit = forest.RandomForestClassifier.fit
    monkeypatch.setattr(
        forest.RandomForestClassifier, "fit", lambda self, df: (seen.append(df.count()), fit(self, df))[1]
    )
    rows = spark.range(20_500).select(
        F.col("id").alias("id_contrato"),
        (F.xxhash64("id") % 50).cast("double").alias("x"),
        (F.col("id") % 2).alias("inadimplente"),
    )
    fit_forest(rows, [encode.SignatureColumn("x", "double")], ForestParams(1, 1))
    assert seen == [20_500]


def test_trees_fitted_in_passes_are_one_forest(features, signature, monkeypatch):
    """Seven trees in three passes: those of a fit with each pass's seed, in order."""

    def written(model):
        return [tree.toDebugString.split("\n", 1)[1] for tree in model.trees]

    wanted = []
    for n, seed in ((2, 42), (2, 43), (3, 44)):
        wanted += written(fit_forest(features, signature, ForestParams(n, 4, seed=seed, least_partitions=3)))
    monkeypatch.setattr(forest, "MOST_BAGGED", 3 * features.count())
    model = fit_forest(features, signature, ForestParams(7, 4, least_partitions=3))
    assert model.getNumTrees == 7 and written(model) == wanted
    assert model.getOrDefault("maxDepth") == 4 and model.numFeatures == len(signature)


@pytest.mark.parametrize("share", [2, 10_000])
def test_large_forests_answer_in_blocks_of_trees(features, signature, model, monkeypatch, share):
    from crivo.operators import trees

    sent, most_nodes = [], max(1, model.totalNumNodes // share)
    read = trees._trees
    monkeypatch.setattr(trees, "_trees", lambda nodes: sent.append(read(nodes)) or sent[-1])
    one = score_forest(features, model, signature, ["id_contrato"]).orderBy("id_contrato").collect()
    monkeypatch.setattr(forest, "MOST_NODES", most_nodes)
    assert forest.is_large(model)
    blocks = score_forest(features, model, signature, ["id_contrato"], whole_table=True)
    assert blocks.orderBy("id_contrato").collect() == one
    assert len(sent) > 1 and sum(len(s.roots) for s in sent) == 4
    assert all(len(s.split) <= most_nodes or len(s.roots) == 1 for s in sent)
