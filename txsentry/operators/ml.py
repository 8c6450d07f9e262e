"""Model operators on Spark MLlib: pipelines, training, tuning, scoring, model
files, metrics from the MLlib evaluators and a run log table.

Training and scoring are MLlib's distributed implementations; nothing here
collects rows. What reaches the driver is model metadata only (parameter maps,
a feature-importance vector of length = number of features, metric scalars).
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import threading
import warnings
from concurrent.futures import Future
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.functions.hashing import hash_uniform
from txsentry.operators.features import assembler, scaler
from txsentry.operators.sampling import split_label
from txsentry.session import remove_path, scratch_path
from txsentry.sources.tables import FEATURES, ID, LABEL

# Parameters of the weekly training job, of the other models and of the
# sampled searches. minInfoGain is 0.0 here: a gini gain is
# at most 0.5, so a larger value turns every tree into a single leaf.
RF_JOB_PARAMS = dict(
    numTrees=200,
    maxDepth=10,
    minInstancesPerNode=7,
    minInfoGain=0.0,
    featureSubsetStrategy="sqrt",
    bootstrap=True,
    seed=42,
)
RF_BASELINE_PARAMS = dict(numTrees=40, seed=42)  # all else at MLlib's defaults
GBT_PARAMS = dict(maxIter=10, seed=42)
DT_A_PARAMS: dict = dict(seed=42)
DT_B_PARAMS = dict(maxDepth=7, seed=42)

# How the trees are grown, not what they are: node ids of the training rows are
# cached between levels instead of shipping the growing trees to every task, and
# that cache (and a boosted model's running predictions) is checkpointed every 10
# iterations to the SparkContext checkpoint folder, which bounds the lineage of a
# deep tree or a long boosting run and survives a lost executor. Overridable per call.
TREE_EXEC_PARAMS = dict(cacheNodeIds=True, checkpointInterval=10)
# A forest's rows would carry a node id per tree, rewritten at every level, beside their draw
# per tree; its trees are shipped instead.
FOREST_EXEC_PARAMS = dict(TREE_EXEC_PARAMS, cacheNodeIds=False)

# A forest holds every row with its bootstrap draws, four bytes a tree, for all levels. So
# many draws one task holds at most, so many all fits of a search that run at once (one
# fit runs in any case), and into so many tasks fewer rows are dealt.
TASK_DRAWS, SEARCH_DRAWS, MIN_TASKS = 1 << 24, 1 << 31, 8
# With fewer draws a fit takes no longer than the few small jobs that cut a stored forest.
SHARED_DRAWS = 1 << 26

# Search space of the sampled search: trees, depth, impurity.
SEARCH_SPACE = {
    "numTrees": [100, 200, 300, 400],
    "maxDepth": list(range(2, 11)),
    "impurity": ["gini", "entropy"],
}
# Search space of the cross-validated search.
CV_SPACE = {
    "numTrees": [100, 200, 300],
    "maxDepth": list(range(2, 7)),
    "impurity": ["gini", "entropy"],
}


def rule_model(threshold: float, amount: str = "tx_amount") -> PipelineModel:
    """A fixed rule as a pipeline model: flag amounts above ``threshold``. It saves,
    loads and scores like any fitted pipeline (batch and stream), and its
    predictions are reproducible by plain SQL."""
    stmt = (
        f"SELECT *, CAST({amount} AS DOUBLE) AS score, "
        f"CAST({amount} > {float(threshold)!r} AS DOUBLE) AS prediction FROM __THIS__"
    )
    return PipelineModel(stages=[SQLTransformer(statement=stmt)])


def _check_gain(params: dict) -> None:
    if params.get("minInfoGain", 0.0) > 0.5 and params.get("impurity", "gini") == "gini":
        warnings.warn("minInfoGain above 0.5 cannot be reached with gini impurity: every tree will be one leaf")


def rf_pipeline(features: list[str] | None = None, label: str = LABEL, scaled: bool = True, **params) -> Pipeline:
    """Assembler -> min-max scaler -> random forest. The scaler is fitted inside the
    pipeline, on the training rows only."""
    p = {**RF_JOB_PARAMS, **params}
    _check_gain(p)
    stages = [assembler(features)]
    fcol = "features"
    if scaled:
        stages.append(scaler())
        fcol = "scaledFeatures"
    stages.append(RandomForestClassifier(labelCol=label, featuresCol=fcol, **{**FOREST_EXEC_PARAMS, **p}))
    return Pipeline(stages=stages)


def rf_baseline(features: list[str] | None = None, label: str = LABEL, **params) -> Pipeline:
    """The baseline forest: 40 trees, MLlib's defaults (depth 5, one row per leaf), on
    unscaled features."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", **{**FOREST_EXEC_PARAMS, **RF_BASELINE_PARAMS, **params})
    return Pipeline(stages=[assembler(features), rf])


def dealt(df: DataFrame, trees: int) -> tuple[DataFrame, int]:
    """``df`` dealt evenly to tasks of at most ``TASK_DRAWS`` draws of a forest of ``trees``,
    whatever files it lies in, and the number of its rows."""
    rows = df.count()
    return df.repartition(max(-(-rows * trees // TASK_DRAWS), MIN_TASKS)), rows


def fit_forest(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit a pipeline that ends in a forest; its passes read the dealt rows."""
    data, _ = dealt(train, pipeline.getStages()[-1].getNumTrees())
    data.persist()
    try:
        return pipeline.fit(data)
    finally:
        data.unpersist()


def gbt_pipeline(features: list[str] | None = None, label: str = LABEL, **params) -> Pipeline:
    gbt = GBTClassifier(labelCol=label, featuresCol="features", **{**TREE_EXEC_PARAMS, **GBT_PARAMS, **params})
    return Pipeline(stages=[assembler(features), gbt])


def dt_pipeline(features: list[str] | None = None, label: str = LABEL, **params) -> Pipeline:
    dt = DecisionTreeClassifier(labelCol=label, featuresCol="scaledFeatures", **{**TREE_EXEC_PARAMS, **params})
    return Pipeline(stages=[assembler(features), scaler(), dt])


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None, label: str = LABEL) -> DataFrame:
    """Prediction table: id, label, prediction (and the positive-class probability
    when the model has one)."""
    out = model.transform(df)
    cols = [*(keep or [ID]), label, "prediction"]
    if "probability" in out.columns:
        return out.select(*cols, vector_to_array("probability")[1].alias("p_fraud"))
    if "score" in out.columns:
        return out.select(*cols, F.col("score").alias("p_fraud"))
    return out.select(*cols)


def importances(model: PipelineModel, features: list[str] | None = None) -> list[tuple[str, float]]:
    """Feature importances of the tree stage (one value per feature, sums to 1)."""
    tree = model.stages[-1]
    vec = tree.featureImportances.toArray().tolist()
    return list(zip(features or FEATURES, vec))


def importances_frame(spark: SparkSession, model: PipelineModel, features: list[str] | None = None, name: str = "model") -> DataFrame:
    rows = [(name, f, float(v)) for f, v in importances(model, features)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- tuning ---------------------------------------------------------------


def grid_maps(rf: RandomForestClassifier, num_trees=(100, 200), max_depth=(2, 7), impurity=("gini",)):
    return ParamGridBuilder().addGrid(rf.numTrees, list(num_trees)).addGrid(rf.maxDepth, list(max_depth)).addGrid(rf.impurity, list(impurity)).build()


def random_maps(rf: RandomForestClassifier, n_trials: int, seed: int = 42, space: dict | None = None):
    """``n_trials`` parameter maps in random order: all points of the space in the order
    of the md5 of 'seed:round:values', without repeats within a round; a further round
    over the whole space follows as often as needed."""
    space = space or SEARCH_SPACE
    points = list(itertools.product(*space.values()))
    maps: list[dict] = []
    for turn in itertools.count():
        if len(maps) >= n_trials:
            return maps[:n_trials]
        order = sorted(points, key=lambda p: hashlib.md5(":".join(map(str, (seed, turn, *p))).encode()).hexdigest())
        maps += [{rf.getParam(n): v for n, v in zip(space, p)} for p in order]


def _tuning_frame(spark: SparkSession, maps, metrics, metric_name: str, method: str) -> DataFrame:
    best = max(range(len(metrics)), key=lambda i: metrics[i])
    rows = []
    for i, (m, v) in enumerate(zip(maps, metrics)):
        params = {p.name: m[p] for p in m}
        rows.append((method, i, json.dumps(params, sort_keys=True), int(params.get("numTrees", 0)), int(params.get("maxDepth", 0)), str(params.get("impurity", "")), metric_name, float(v), i == best))
    schema = "method string, trial int, params string, num_trees int, max_depth int, impurity string, metric string, value double, is_best boolean"
    return spark.createDataFrame(rows, schema)


def best_params(spark: SparkSession, model, name: str = "best") -> DataFrame:
    """The winning model's full parameter listing, one row per parameter."""
    tree = model.bestModel
    rows = [(name, p.name, str(tree.getOrDefault(p))) for p in tree.params if tree.isDefined(p)]
    return spark.createDataFrame(rows, "model string, param string, value string")


class SearchForest(RandomForestClassifier):
    """A random forest whose fits for many parameter maps, as a tuner asks for them
    (``fitMultiple``), are shared by the maps that differ in depth alone.

    A forest is grown level by level, and no draw of a level depends on the levels to come:
    with the same rows, seed and trees, a forest of smaller depth is the deeper one cut at
    that depth. So the deepest map of such a group is fitted, and the others' forests, equal
    to those of their own fits, are cut from it. That holds as long as a level's nodes fit
    ``maxMemoryInMB``, beyond which they are split in turns; such maps are fitted on their own.
    At most ``at_once`` fits run together, however many threads ask; cutting a forest and
    scoring with it holds no draws and goes on meanwhile. Where the number of ``rows`` is given
    and a fit would hold fewer than ``SHARED_DRAWS`` draws, each map is fitted on its own: the
    same forests, sooner.
    """

    at_once = 1
    rows: int | None = None

    def _level_fits(self, trees: int, depth: int, n_features: int) -> bool:
        """Whether the statistics (two classes) of the widest level split fit one turn."""
        of = math.ceil(math.sqrt(n_features)) if trees > 1 and self.getFeatureSubsetStrategy() in ("auto", "sqrt") else n_features
        return trees * 2 ** max(depth - 1, 0) * of * self.getMaxBins() * 2 * 8 <= self.getMaxMemoryInMB() << 20

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """A thread-safe iterator of (place in ``paramMaps``, model), the fits first; each
        group's cuts follow in the order of the fits."""
        spark = dataset.sparkSession
        n_features = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs", len(FEATURES))
        groups: dict = {}
        of = []
        depths = [m.get(self.maxDepth, self.getMaxDepth()) for m in paramMaps]
        for m, depth in zip(paramMaps, depths):
            trees = m.get(self.numTrees, self.getNumTrees())
            shared = self._level_fits(trees, depth, n_features) and (self.rows is None or self.rows * trees >= SHARED_DRAWS)
            group = (*sorted((p.name, v) for p, v in m.items() if p.name != "maxDepth"), None if shared else depth)
            groups.setdefault(group, []).append(len(of))
            of.append(group)
        deepest = {g: max(places, key=lambda i: depths[i]) for g, places in groups.items()}
        stored = {g: Future() for g in groups}
        turn = threading.Semaphore(self.at_once)
        waiting = {g: sorted(set(places) - {deepest[g]}) for g, places in groups.items()}

        def fitted(i: int):
            g = of[i]
            if i != deepest[g]:
                path = stored[g].result()
                model = _cut_forest(spark, path, depths[i])
                waiting[g].remove(i)
                if not waiting[g]:
                    remove_path(spark, path)
                return i, model
            try:
                with turn:
                    model = self.fit(dataset, paramMaps[i])
                stored[g].set_result(_store_forest(spark, model) if waiting[g] else None)
            except BaseException as e:
                stored[g].set_exception(e)  # those that wait for it fail as well
                raise
            return i, model

        # the next place is taken under the interpreter's lock, the fit itself runs outside it
        return map(fitted, [*deepest.values(), *(i for g in groups for i in list(waiting[g]))])


# A leaf's depth of no return: no forest makes it an inner node.
NEVER = 1 << 30


def _inner_from():
    """For the nodes of one saved tree (ids in order of a walk from the root, left before
    right) the least depth of a forest in which a node is an inner one: the depth at which
    leaves below it first predict differently, since siblings that predict alike are merged.
    Once they do, deeper ones do too. Made inside a function so that it is sent to the
    workers by value."""
    never = NEVER

    def walk(tree):
        tree = tree.sort_values("id")
        left, right, says = (tree[c].tolist() for c in ("leftChild", "rightChild", "prediction"))
        level, least = [0] * len(tree), [never] * len(tree)
        inner = [i for i, child in enumerate(left) if child >= 0]
        for i in inner:
            level[left[i]] = level[right[i]] = level[i] + 1
        for i in reversed(inner):
            a, b = left[i], right[i]
            least[i] = level[i] + 1 if says[a] != says[b] else min(least[a], least[b])
        return tree[["treeID", "id"]].assign(inner_from=least)

    return walk


def _store_forest(spark: SparkSession, model: RandomForestClassificationModel) -> str:
    """The model saved below a scratch path, with a table of its nodes that says from which
    depth on each one is an inner node."""
    path = scratch_path(spark, "forest")
    model.save(f"{path}/model")
    nodes = spark.read.parquet(f"{path}/model/data")
    flat = nodes.select("treeID", *(f"nodeData.{c}" for c in ("id", "leftChild", "rightChild", "prediction")))
    least = flat.groupBy("treeID").applyInPandas(_inner_from(), "treeID int, id int, inner_from int")
    nodes.withColumn("id", F.col("nodeData.id")).join(least, ["treeID", "id"]).drop("id").write.parquet(f"{path}/nodes")
    return path


def _cut_forest(spark: SparkSession, path: str, depth: int) -> RandomForestClassificationModel:
    """The stored forest as a fit with maximum depth ``depth`` gives it. Nodes below the cut
    stay in the saved table, out of the root's reach."""
    to = scratch_path(spark, "cut")
    node, leaf = F.col("nodeData"), F.col("inner_from") > F.lit(depth)
    for child in ("leftChild", "rightChild"):
        node = node.withField(child, F.when(leaf, F.lit(-1)).otherwise(F.col(f"nodeData.{child}")))
    spark.read.parquet(f"{path}/nodes").select("treeID", node.alias("nodeData")).write.parquet(f"{to}/data")
    spark.read.text(f"{path}/model/metadata").write.text(f"{to}/metadata")
    spark.read.parquet(f"{path}/model/treesMetadata").write.parquet(f"{to}/treesMetadata")
    model = RandomForestClassificationModel.load(to)
    remove_path(spark, to)
    model.set(model.maxDepth, depth)
    return model


def _rf_for_tuning(label: str) -> SearchForest:
    return SearchForest(labelCol=label, featuresCol="features", seed=42, **FOREST_EXEC_PARAMS)


# The tuners' own splits draw by row and so depend on the layout. Folds are marked by a
# hash of the key instead; a single train / validation split is one fold of such a
# cross-validation, evaluated on the fold that holds ``1 - train_ratio`` of the rows.


def _most_trees(maps, est) -> int:
    return max(m.get(est.numTrees, est.getNumTrees()) for m in maps)


def _distinct(maps) -> tuple[list, list[int]]:
    """The different ones of ``maps`` in order, and each map's place among them. A forest is
    fixed by its parameters, seed and dealt rows, so a map that is drawn again has the metric it had."""
    place: dict = {}
    at = [place.setdefault(tuple(sorted((p.name, v) for p, v in m.items())), len(place)) for m in maps]
    return [maps[at.index(i)] for i in range(len(place))], at


def _at_once(rows: int, trees: int, parallelism: int) -> int:
    """How many of ``parallelism`` fits run together: those whose draws fit ``SEARCH_DRAWS``."""
    return max(1, min(parallelism, SEARCH_DRAWS // max(1, rows * trees)))


def _holdout(maps, est, ev, data: DataFrame, key: str, train_ratio: float, seed: int, parallelism: int):
    different, at = _distinct(maps)
    trees = _most_trees(maps, est)
    data, rows = dealt(data, trees)
    part = split_label(key, [train_ratio, 1 - train_ratio], ["train", "validation"], seed)
    data = assembler().transform(data).withColumn("_part", part).persist()
    train, valid = (data.filter(F.col("_part") == name) for name in ("train", "validation"))
    est.rows, est.at_once = rows, _at_once(rows, trees, parallelism)
    models = est.fitMultiple(train, different)

    def metric(_) -> tuple[int, float]:
        i, model = next(models)
        return i, ev.evaluate(model.transform(valid))

    try:
        with ThreadPool(parallelism) as pool:
            found = dict(pool.map(metric, different, chunksize=1))
        metrics = [found[i] for i in at]
        best = max(range(len(metrics)), key=lambda i: metrics[i])
        return est.copy(maps[best]).fit(data), metrics
    finally:
        data.unpersist()


class TunedModel:
    """The best model of a search, refitted on all rows, and each trial's metric."""

    def __init__(self, best_model, metrics: list[float]):
        self.bestModel, self.validationMetrics = best_model, metrics


def tune_grid(train: DataFrame, label: str = LABEL, train_ratio: float = 0.8, parallelism: int = 3, seed: int = 42, key: str = ID, **grid):
    """Grid search with a train/validation split, scored by area under ROC."""
    rf = _rf_for_tuning(label)
    maps = grid_maps(rf, **grid)
    ev = BinaryClassificationEvaluator(labelCol=label)
    model = TunedModel(*_holdout(maps, rf, ev, train, key, train_ratio, seed, parallelism))
    return model, _tuning_frame(train.sparkSession, maps, model.validationMetrics, ev.getMetricName(), "grid")


def tune_random(train: DataFrame, n_trials: int = 50, label: str = LABEL, train_ratio: float = 0.8, parallelism: int = 3, seed: int = 42, key: str = ID):
    """Sampled search over the search space, scored by area under PR."""
    rf = _rf_for_tuning(label)
    maps = random_maps(rf, n_trials, seed)
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    model = TunedModel(*_holdout(maps, rf, ev, train, key, train_ratio, seed, parallelism))
    return model, _tuning_frame(train.sparkSession, maps, model.validationMetrics, "areaUnderPR", "random")


def tune_cv(train: DataFrame, n_trials: int = 40, folds: int = 2, label: str = LABEL, parallelism: int = 3, seed: int = 42, key: str = ID):
    """Maps drawn from the search's own space under k-fold cross-validation; a row's fold
    is a hash of its key."""
    rf = _rf_for_tuning(label)
    maps = random_maps(rf, n_trials, seed, CV_SPACE)
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    fold = F.floor(hash_uniform(key, seed, salt=F.lit("fold")) * folds).cast("int")
    different, at = _distinct(maps)
    trees = _most_trees(maps, rf)
    data, rows = dealt(train, trees)
    data = assembler().transform(data).withColumn("_fold", F.coalesce(fold, F.lit(0))).persist()
    rf.rows, rf.at_once = rows, _at_once(rows, trees, parallelism)
    cv = CrossValidator(estimator=rf, estimatorParamMaps=different, evaluator=ev, numFolds=folds, parallelism=parallelism, seed=seed, foldCol="_fold")
    try:
        model = cv.fit(data)
    finally:
        data.unpersist()
    return model, _tuning_frame(train.sparkSession, maps, [model.avgMetrics[i] for i in at], "areaUnderPR", "cv")


# --- metrics from the MLlib evaluators -------------------------------------


def ml_metrics(pred: DataFrame, label: str = LABEL, raw: str = "rawPrediction", prediction: str = "prediction", num_bins: int = 1000) -> dict[str, float]:
    """F-measure of label 1, areas under PR and ROC, RMSE of the prediction."""
    lab = pred.withColumn(label, F.col(label).cast("double"))
    bin_pr = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderPR", numBins=num_bins)
    bin_roc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=num_bins)
    f1 = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0)
    rm = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return {
        "f1_label1": f1.evaluate(lab),
        "area_under_pr": bin_pr.evaluate(lab),
        "area_under_roc": bin_roc.evaluate(lab),
        "rmse": rm.evaluate(lab),
    }


# --- run log ----------------------------------------------------------------

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("logged_at", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def log_run(spark: SparkSession, path: str, run: str, params: dict, metrics: dict) -> DataFrame:
    """Append a run's parameters and metrics to a Parquet table (one row per item)."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [(run, now, "param", k, json.dumps(v) if not isinstance(v, str) else v) for k, v in params.items()]
    rows += [(run, now, "metric", k, repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).write.mode("append").parquet(path)
    return spark.read.parquet(path)
