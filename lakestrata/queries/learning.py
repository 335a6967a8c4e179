"""Feature preparation, evaluation, model imputation and scoring."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.stable import hash_split
from lakestrata.ml import evaluate, features, models
from lakestrata.operators.ids import dense_id
from lakestrata.queries.registry import Source, query


def _rated(src: Source) -> DataFrame:
    """Documents with a quality label where one exists."""
    return src.documents.select("doc_id", "lang", "source", "n_chars").join(src.labels, ["doc_id"], "left")


@query("op_split_by_target", """
    SELECT d.doc_id, lang, n_chars, quality, quality IS NOT NULL AS labelled
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def split_by_target(src: Source) -> DataFrame:
    known, unknown = features.split_by_target(_rated(src), "quality", drop=["toxic", "source"])
    return known.withColumn("labelled", F.lit(True)).unionByName(unknown.withColumn("labelled", F.lit(False)))


@query("op_onehot", """
    SELECT c_custkey, c_acctbal, (c_mktsegment = 'BUILDING')::INTEGER AS building,
           (c_mktsegment = 'FURNITURE')::INTEGER AS furniture, (c_mktsegment = 'HOUSEHOLD')::INTEGER AS household,
           (c_mktsegment = 'MACHINERY')::INTEGER AS machinery
    FROM customer
""")
def onehot(src: Source) -> DataFrame:
    frame = src.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    model = features.fit_stages(frame, features.one_hot_stages(["c_mktsegment"]))
    levels = model.stages[0].labelsArray[0][:-1]
    slots = vector_to_array("c_mktsegment_hot")
    return model.transform(frame).select(
        "c_custkey", "c_acctbal", *[slots[i].cast("int").alias(level.lower()) for i, level in enumerate(levels)]
    )


def _masked_sizes(src: Source) -> DataFrame:
    return src.part.select("p_partkey", F.when(F.col("p_type") != "ECONOMY", F.col("p_size")).alias("size"))


@query("op_mean_impute", """
    SELECT p_partkey, CASE WHEN p_type <> 'ECONOMY' THEN CAST(p_size AS DOUBLE)
           ELSE (SELECT avg(p_size) FROM part WHERE p_type <> 'ECONOMY') END AS size
    FROM part
""")
def mean_impute(src: Source) -> DataFrame:
    frame = features.coerce_numbers(_masked_sizes(src), ["size"])
    return Imputer(inputCols=["size"], outputCols=["size"], strategy="mean").fit(frame).transform(frame)


@query("op_standardise", """
    SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS z
    FROM customer
""")
def standardise(src: Source) -> DataFrame:
    frame = VectorAssembler(inputCols=["c_acctbal"], outputCol="v").transform(src.customer.select("c_custkey", "c_acctbal"))
    scaler = StandardScaler(inputCol="v", outputCol="scaled", withMean=True, withStd=True).fit(frame)
    return scaler.transform(frame).select("c_custkey", F.round(vector_to_array("scaled")[0], 6).alias("z"))


@query("op_class_weights", """
    SELECT p_type, (SELECT count(*) FROM part)::DOUBLE / ((SELECT count(DISTINCT p_type) FROM part) * count(*)) AS weight
    FROM part GROUP BY p_type
""")
def class_weights(src: Source) -> DataFrame:
    return features.class_weights(src.part, "p_type")


def _rule_scores(src: Source) -> DataFrame:
    lengths = src.documents.select("doc_id", "n_chars")
    return src.labels.join(lengths, ["doc_id"]).select(
        "quality", (F.col("n_chars") >= 1000).cast("int").alias("predicted"),
        F.least(F.col("n_chars") / 4096, F.lit(1.0)).alias("score"),
    )


_RULE_SCORES = """
    SELECT quality, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS predicted, least(n_chars / 4096, 1.0) AS score
    FROM labels JOIN documents USING (doc_id)
"""


@query("op_confusion_matrix", f"""
    SELECT quality, predicted, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY quality)::DOUBLE AS share
    FROM ({_RULE_SCORES}) GROUP BY quality, predicted
""")
def confusion_matrix(src: Source) -> DataFrame:
    return evaluate.confusion_matrix(_rule_scores(src), "quality", "predicted")


@query("op_micro_f1", f"""
    SELECT count(*) AS n, sum((quality = predicted)::INTEGER)::BIGINT AS n_right,
           sum((quality = predicted)::INTEGER)::DOUBLE / count(*) AS micro_f1 FROM ({_RULE_SCORES})
""")
def micro_f1(src: Source) -> DataFrame:
    return evaluate.micro_f1(_rule_scores(src), "quality", "predicted")


@query("op_binary_metrics", f"""
    WITH c AS (SELECT sum(CASE WHEN quality = 1 AND predicted = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
                      sum(CASE WHEN quality = 0 AND predicted = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
                      sum(CASE WHEN quality = 1 AND predicted = 0 THEN 1 ELSE 0 END)::BIGINT AS fn,
                      sum(CASE WHEN quality = 0 AND predicted = 0 THEN 1 ELSE 0 END)::BIGINT AS tn
               FROM ({_RULE_SCORES}))
    SELECT tp, fp, fn, tn, (tp + tn)::DOUBLE / nullif(tp + fp + fn + tn, 0) AS accuracy,
           tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall,
           (2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0) AS f1 FROM c
""")
def binary_metrics(src: Source) -> DataFrame:
    return evaluate.binary_metrics(_rule_scores(src), "quality", "predicted")


@query("op_roc_points", f"""
    WITH b AS (SELECT CAST(floor(score * 64) AS INTEGER) AS bucket, sum(quality)::BIGINT AS p, count(*) AS n
               FROM ({_RULE_SCORES}) GROUP BY 1),
    c AS (SELECT bucket, sum(p) OVER w::BIGINT AS tp, sum(n - p) OVER w::BIGINT AS fp,
                 sum(p) OVER () AS all_p, sum(n - p) OVER () AS all_n
          FROM b WINDOW w AS (ORDER BY bucket DESC))
    SELECT bucket / 64 AS threshold, tp, fp, tp::DOUBLE / nullif(all_p, 0)::DOUBLE AS recall,
           fp::DOUBLE / nullif(all_n, 0)::DOUBLE AS false_positive_rate, tp::DOUBLE / nullif(tp + fp, 0) AS precision
    FROM c
""")
def roc_points(src: Source) -> DataFrame:
    return evaluate.binned_roc_points(_rule_scores(src), "quality", "score", bins=64)


_EXACT_COUNTS = f"""b AS (SELECT score, sum(quality)::BIGINT AS p, count(*) - sum(quality)::BIGINT AS q FROM ({_RULE_SCORES}) GROUP BY 1),
    c AS (SELECT score, p, q, sum(p) OVER w::BIGINT AS tp, sum(q) OVER w::BIGINT AS fp,
                 sum(p) OVER () AS all_p, sum(q) OVER () AS all_n
          FROM b WINDOW w AS (ORDER BY score DESC))"""


@query("op_roc_exact", f"""
    WITH {_EXACT_COUNTS}
    SELECT score::DOUBLE AS threshold, tp, fp, tp::DOUBLE / nullif(all_p, 0)::DOUBLE AS recall,
           fp::DOUBLE / nullif(all_n, 0)::DOUBLE AS false_positive_rate, tp::DOUBLE / nullif(tp + fp, 0) AS precision
    FROM c
""")
def roc_exact(src: Source) -> DataFrame:
    return evaluate.roc_points(_rule_scores(src), "quality", "score")


@query("op_ranking_metrics", f"""
    WITH {_EXACT_COUNTS}
    SELECT round(sum(q * (tp - p) + q * p / 2.0) / max(all_p * all_n)::DOUBLE, 9) AS roc_auc,
           round(sum(p::DOUBLE * tp / (tp + fp)) / max(all_p)::DOUBLE, 9) AS average_precision
    FROM c
""")
def ranking_metrics(src: Source) -> DataFrame:
    """Log loss is left to the tests: the scores of this rule include 0 and 1."""
    found = evaluate.ranking_metrics(_rule_scores(src), "quality", "score")
    return found.select(F.round("roc_auc", 9).alias("roc_auc"), F.round("average_precision", 9).alias("average_precision"))


# Targets of the fitted models are rules of the features, hidden for a share of the rows that the key's hash picks.
# Trees deep enough, with a bin for every value, must find the rule, so the oracle is the rule itself.
_EXACT_TREES = {"maxBins": 1024, "minInstancesPerNode": 1}


def _steps(src: Source) -> DataFrame:
    """Documents with their length in steps and a class that follows from it, unknown for a third."""
    steps = src.documents.select("doc_id", "lang", F.floor(F.col("n_chars") / 400).cast("int").alias("step"))
    rule = F.when(F.col("step") >= 5, 1).otherwise(0)
    return steps.withColumn("known", F.col("doc_id") % 3 != 1).withColumn("long", F.when(F.col("known"), rule))


_LONG = "CASE WHEN n_chars // 400 >= 5 THEN 1 ELSE 0 END"


@query("op_impute_model", f"SELECT doc_id, (n_chars // 400)::INTEGER AS step, doc_id % 3 <> 1 AS known, {_LONG} AS long FROM documents")
def impute_model(src: Source) -> DataFrame:
    """A missing class from a balanced forest; known ones stay."""
    frame = _steps(src)
    model = models.train_classifier(
        frame, "long", ["step"], ["lang"],
        models.balanced_forest("label", numTrees=5, maxDepth=6, featureSubsetStrategy="all", **_EXACT_TREES), balanced=True,
    )
    return models.impute_target(frame, model, "long", ["step"]).select("doc_id", "step", "known", "long")


@query("op_score_batch", f"SELECT doc_id, (n_chars // 400)::INTEGER AS step, {_LONG} AS long FROM documents")
def score_batch(src: Source) -> DataFrame:
    """Score every document with boosted trees that stop early on the validation part; preparation sees the training part."""
    frame = _steps(src)
    rated = frame.withColumn("part", hash_split(F.col("doc_id"))).where("part <> 'test'").withColumn("is_validation", F.col("part") == "val")
    model = models.train_classifier(
        rated, "long", ["step"], ["lang"], models.boosted_binary("label", "is_validation", maxIter=5, maxDepth=4, seed=1, **_EXACT_TREES),
        standardise=True, prepare_on="not is_validation",
    )
    return models.predict(model, frame.drop("long", "known"), ["step"], "long").select("doc_id", "step", "long")


def _sized(src: Source) -> DataFrame:
    """Parts with a class that follows from their size, unknown for a quarter."""
    rule = F.when(F.col("p_size") < 17, 1).when(F.col("p_size") < 34, 2).otherwise(3)
    rows = src.part.select("p_partkey", "p_brand", "p_size", (F.col("p_partkey") % 4 != 2).alias("known"))
    return rows.withColumn("size_class", F.when(F.col("known"), rule))


_SIZED = """SELECT p_partkey, p_size, p_partkey % 4 <> 2 AS known,
           CASE WHEN p_size < 17 THEN 1 WHEN p_size < 34 THEN 2 ELSE 3 END AS size_class FROM part"""


@query("op_impute_boosted", _SIZED)
def impute_boosted(src: Source) -> DataFrame:
    """Missing size classes from one boosted model of all classes."""
    frame = _sized(src)
    booster = models.boosted_classes("label", maxIter=3, stepSize=1.0, maxDepth=3, minInstancesPerNode=1)
    model = models.train_classifier(frame, "size_class", ["p_size"], ["p_brand"], booster, first_class=1)
    return models.impute_target(frame, model, "size_class", ["p_size"], first_class=1).select("p_partkey", "p_size", "known", "size_class")


@query("op_boosted_multiclass", """
    SELECT l_orderkey, l_linenumber, l_quantity::INTEGER AS quantity, CASE WHEN l_discount < 0.03 THEN 0 WHEN l_quantity < 20 THEN 1
           WHEN l_quantity < 35 THEN 2 ELSE 3 END AS grade FROM lineitem
""")
def boosted_multiclass(src: Source) -> DataFrame:
    """Four grades that follow from two measures, learned from a half of the lines, told of all."""
    rule = F.when(F.col("l_discount") < 0.03, 0).when(F.col("l_quantity") < 20, 1).when(F.col("l_quantity") < 35, 2).otherwise(3)
    frame = src.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"), F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        "l_returnflag", F.when(F.col("l_orderkey") % 2 == 0, rule).alias("known_grade"),
    )
    booster = models.boosted_classes("label", maxIter=3, stepSize=1.0, maxDepth=3, minInstancesPerNode=1)
    model = models.train_classifier(frame, "known_grade", ["quantity", "discount"], ["l_returnflag"], booster)
    return models.predict(model, frame, ["quantity", "discount"], "grade").select("l_orderkey", "l_linenumber", "quantity", "grade")


@query("op_cross_fitted", """
    SELECT p_partkey, p_size, p_partkey % 3 <> 0 AS known, CASE WHEN p_size < 26 THEN 1 ELSE 2 END AS predicted FROM part
    WHERE p_size % 5 = 0
""")
def cross_fitted(src: Source) -> DataFrame:
    """A prediction for every part by a model that never saw it; sizes are few, so that each fold knows all of them."""
    rule = F.when(F.col("p_size") < 26, 1).otherwise(2)
    frame = src.part.where("p_size % 5 = 0").select("p_partkey", "p_size", (F.col("p_partkey") % 3 != 0).alias("known"))
    frame = frame.withColumn("target", F.when(F.col("known"), rule))

    def fit(rows: DataFrame):
        booster = models.boosted_classes("label", maxIter=3, stepSize=1.0, maxDepth=2, minInstancesPerNode=1)
        return models.train_classifier(rows, "target", ["p_size"], [], booster, first_class=1)

    found = models.cross_fitted(frame, "target", "p_partkey", fit, ["p_size"], "predicted", first_class=1)
    return found.select("p_partkey", "p_size", "known", "predicted")


@query("op_feature_importance", """
    SELECT 'step_filled' AS feature, (count(DISTINCT n_chars // 400 >= 5) = 2)::INTEGER::DOUBLE AS importance FROM documents
    UNION ALL SELECT 'same_filled', 0.0::DOUBLE
""")
def feature_importance(src: Source) -> DataFrame:
    """How much each feature weighs: one that decides the class, and one that is the same everywhere."""
    frame = _steps(src).withColumn("same", F.lit(1.0))
    model = models.train_classifier(
        frame, "long", ["step", "same"], [],
        models.balanced_forest("label", numTrees=3, maxDepth=4, featureSubsetStrategy="all", **_EXACT_TREES), balanced=True,
    )
    found = models.feature_importance(model, model.transform(features.coerce_numbers(frame, ["step", "same"])))
    return found.select("feature", F.round("importance", 9).alias("importance"))


# The pairing of n rows: a prime to n near 0.618 n, found among the numbers from there on.
_STEPPED = """n AS (SELECT count(*) AS n FROM documents),
    a AS (SELECT min(k) AS a FROM (SELECT n, unnest(range(greatest(1, floor(n * 0.6180339887498949)::BIGINT), 2 * n + 2)) AS k FROM n) WHERE gcd(k, n) = 1),
    d AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, n_chars // 400 AS step, length(lang) AS same, doc_id % 3 <> 1 AS known FROM documents)"""


@query("op_permutation_importance", f"""
    WITH {_STEPPED},
    p AS (SELECT (x.step >= 5)::INTEGER AS label, (y.step >= 5)::INTEGER AS taken FROM d x, n, a, d y WHERE y.i = (x.i * a.a + 1) % n.n AND NOT x.known)
    SELECT 'step' AS feature, count(*) AS n, 0::BIGINT AS n_wrong, count(*) FILTER (label <> taken) AS n_wrong_exchanged,
           count(*) FILTER (label <> taken)::DOUBLE / count(*) AS importance FROM p
    UNION ALL SELECT 'doc_id_digit', count(*), 0::BIGINT, 0::BIGINT, 0.0::DOUBLE FROM p
""")
def permutation_importance(src: Source) -> DataFrame:
    """On rows that the model never saw: the feature that decides the class, and one that it has no use for."""
    steps = _steps(src).withColumns({"doc_id_digit": F.col("doc_id") % 2, "truth": F.when(~F.col("known"), (F.col("step") >= 5).cast("int"))})
    last = src.documents.agg(F.max("doc_id")).first()[0] or 0
    # ids in the order of doc_id, as the oracle numbers them
    rows = dense_id(steps, "row", ["doc_id"], 4096, bucket=F.floor(F.col("doc_id") * 4096 / (last + 1)).cast("int"))
    model = models.train_classifier(
        rows, "long", ["step", "doc_id_digit"], [],
        models.balanced_forest("label", numTrees=5, maxDepth=6, featureSubsetStrategy="all", **_EXACT_TREES), balanced=True,
    )

    def told(some: DataFrame) -> DataFrame:
        return models.predict(model, some, ["step", "doc_id_digit"], "told")

    return evaluate.permutation_importance(rows, "row", ["step", "doc_id_digit"], told, "truth", "told")
