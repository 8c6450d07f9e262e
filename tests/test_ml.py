import random
import warnings

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txsentry.operators import features as fe
from txsentry.operators import metrics as me
from txsentry.operators import ml
from txsentry.session import scratch_path


def planted(spark, n=1500, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.25)
        amount = rnd.uniform(0, 50) + (60 if y else 0)
        rows.append((i, rnd.randint(0, 100), rnd.randint(0, 20), amount, rnd.randint(0, 86399), y))
    return spark.createDataFrame(rows, "transaction_id long, customer_id long, terminal_id int, tx_amount double, tx_time_seconds int, tx_fraud int")


def test_constant_feature_scales_to_half(spark):
    df = planted(spark, 50).withColumn("terminal_id", F.lit(7))
    model = Pipeline(stages=[fe.assembler(), fe.scaler()]).fit(df)
    vals = model.transform(df).select(vector_to_array("scaledFeatures")[1].alias("t")).distinct().collect()
    assert [r["t"] for r in vals] == [0.5]


def test_forest_learns_planted_signal(spark):
    df = planted(spark)
    model = ml.rf_pipeline(numTrees=20, maxDepth=5).fit(df)
    imp = dict(ml.importances(model))
    assert abs(sum(imp.values()) - 1.0) < 1e-9
    assert max(imp, key=imp.get) == "tx_amount"
    auc = me.auc_roc(ml.score(model, df), score="p_fraud").first()["auc_roc"]
    assert auc > 0.95


def test_min_info_gain_above_half_warns():
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        ml.rf_pipeline(minInfoGain=4.0)
    assert any("minInfoGain" in str(x.message) for x in w)


def test_model_roundtrip_same_predictions(spark):
    df = planted(spark, 400)
    model = ml.dt_pipeline(maxDepth=4, seed=42).fit(df)
    path = ml.save_model(model, scratch_path(spark, "t-model"))
    a = sorted(map(tuple, ml.score(model, df).collect()))
    b = sorted(map(tuple, ml.score(ml.load_model(path), df).collect()))
    assert a == b


def test_rule_model_roundtrip(spark):
    df = planted(spark, 100)
    path = ml.save_model(ml.rule_model(60.0), scratch_path(spark, "t-rule"))
    out = ml.score(ml.load_model(path), df)
    assert out.filter((F.col("prediction") == 1.0) != (F.col("p_fraud") > 60.0)).count() == 0


def test_random_maps_are_seeded_and_distinct(spark):
    rf = ml._rf_for_tuning("tx_fraud")
    a = [tuple(sorted((p.name, v) for p, v in m.items())) for m in ml.random_maps(rf, 10, seed=1)]
    b = [tuple(sorted((p.name, v) for p, v in m.items())) for m in ml.random_maps(rf, 10, seed=1)]
    assert a == b and len(set(a)) == 10


def test_tune_grid_picks_best(spark):
    df = planted(spark, 600)
    model, table = ml.tune_grid(df, num_trees=(5, 10), max_depth=(2, 4))
    rows = table.collect()
    assert len(rows) == 4 and sum(r["is_best"] for r in rows) == 1
    best = max(rows, key=lambda r: r["value"])
    assert best["is_best"]


def test_run_log_appends(spark):
    path = scratch_path(spark, "t-runs")
    ml.log_run(spark, path, "r1", {"numTrees": 10}, {"areaUnderPR": 0.5})
    out = ml.log_run(spark, path, "r2", {"numTrees": 20}, {"areaUnderPR": 0.6})
    assert out.count() == 4 and {r["run"] for r in out.collect()} == {"r1", "r2"}


def test_more_trials_than_points(spark):
    rf = ml._rf_for_tuning("tx_fraud")
    maps = ml.random_maps(rf, 100)
    assert len(maps) == 100
    points = [tuple(sorted((p.name, v) for p, v in m.items())) for m in maps]
    assert len(set(points[:72])) == 72
    assert {m[rf.maxDepth] for m in ml.random_maps(rf, 40, space=ml.CV_SPACE)} == {2, 3, 4, 5, 6}


def test_baseline_forest_parameters():
    rf = ml.rf_baseline().getStages()[-1]
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getMinInstancesPerNode(), rf.getSeed()) == (40, 5, 1, 42)


def test_best_params_listing(spark):
    model, _ = ml.tune_grid(planted(spark, 300), num_trees=(5,), max_depth=(3,))
    got = {r["param"]: r["value"] for r in ml.best_params(spark, model).collect()}
    assert got["numTrees"] == "5" and got["maxDepth"] == "3" and got["impurity"] == "gini"


def test_best_params_of_the_default_grid_are_the_winners(spark):
    """The query's listing against the trial table of the same search."""
    from txsentry.plans import catalog

    sf = "/root/testdata/sf0.001"
    train, _ = catalog._ml_split(spark, sf)
    trials = ml.tune_grid(catalog._deep(train))[1].collect()
    assert {(r["num_trees"], r["max_depth"]) for r in trials} == {(n, d) for n in (100, 200) for d in (2, 7)}
    best = max(trials, key=lambda r: (r["value"], -r["trial"]))
    got = {r["param"]: r["value"] for r in catalog.queries()["best_params_grid"](spark, sf).collect()}
    assert got == {"numTrees": str(best["num_trees"]), "maxDepth": str(best["max_depth"]), "impurity": best["impurity"], "seed": "42"}


def test_searches_do_not_depend_on_the_layout(spark):
    """The rows of the split, the trials and, on a label that trees learn, their metrics."""
    df = planted(spark, 400)
    a, b = ([(r["params"], r["value"]) for r in ml.tune_random(x, n_trials=2)[1].collect()] for x in (df.repartition(2), df.repartition(7)))
    assert a == b
    part = ml.split_label("transaction_id", [0.8, 0.2], ["train", "validation"], 42)
    one, two = (sorted(map(tuple, x.select("transaction_id", part.alias("p")).collect())) for x in (df.repartition(2), df.repartition(7)))
    assert one == two


def _draws_per_task(df, trees):
    return max(len(part) for part in df.select("transaction_id").rdd.glom().collect()) * trees


def test_forest_rows_are_dealt_by_draws(spark, monkeypatch):
    """A task's bootstrap draws stay bounded however few files or large partitions there are."""
    df = planted(spark, 3000).coalesce(1)
    for trees in (200, 400):
        monkeypatch.setattr(ml, "TASK_DRAWS", 20_000)
        data, rows = ml.dealt(df, trees)
        assert rows == 3000 and _draws_per_task(data, trees) <= 20_000 + trees
        assert sorted(map(tuple, data.collect())) == sorted(map(tuple, df.collect()))


def test_forest_fit_bounds_each_task(spark, monkeypatch):
    """The fit itself reads dealt rows, and its rows carry no node id per tree."""
    seen = []
    deal = ml.dealt
    monkeypatch.setattr(ml, "dealt", lambda df, trees: (lambda out: (seen.append((trees, out[0].rdd.getNumPartitions())), out)[1])(deal(df, trees)))
    monkeypatch.setattr(ml, "TASK_DRAWS", 10_000)
    pipe = ml.rf_pipeline(numTrees=20, maxDepth=3)
    model = ml.fit_forest(pipe, planted(spark, 8000).coalesce(1))
    assert seen == [(20, 16)] and model.stages[-1].getNumTrees == 20
    for est in (pipe.getStages()[-1], ml.rf_baseline().getStages()[-1], ml._rf_for_tuning("tx_fraud")):
        assert not est.getCacheNodeIds()


def test_trials_at_once_are_bounded_by_their_draws():
    assert ml._at_once(1000, 400, 8) == 8
    assert ml._at_once(2_000_000, 400, 8) == 2
    assert ml._at_once(50_000_000, 400, 8) == 1


def test_repeated_points_are_fitted_once(spark, monkeypatch):
    """Trials drawn again by a later round: every trial is listed with its point's metric, and
    each point is fitted once a fold, plus the winner's fit on all rows."""
    fits = []
    fit = ml.RandomForestClassifier._fit
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", lambda est, df: (fits.append(est.getNumTrees()), fit(est, df))[1])
    monkeypatch.setattr(ml, "CV_SPACE", {"numTrees": [3, 5], "maxDepth": [2], "impurity": ["gini"]})
    monkeypatch.setattr(ml, "SEARCH_SPACE", ml.CV_SPACE)
    df = planted(spark, 400)
    for run, folds in ((ml.tune_cv, 2), (ml.tune_random, 1)):
        fits.clear()
        rows = run(df, n_trials=5)[1].orderBy("trial").collect()
        assert len(fits) == 2 * folds + 1
        assert len(rows) == 5 and sum(r["is_best"] for r in rows) == 1
        assert len({(r["num_trees"], r["value"]) for r in rows}) == 2


def test_forests_of_smaller_depth_are_cut_from_the_deepest(spark, monkeypatch):
    """Maps that differ in depth alone take one fit, and their forests, probabilities included,
    are those of fits of their own, also where siblings that predict alike were merged."""
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 100), rnd.randint(0, 20), rnd.uniform(0, 50), rnd.randint(0, 86399), int(rnd.random() < 0.3)) for _ in range(600)]
    df = ml.assembler().transform(spark.createDataFrame(rows, "customer_id long, terminal_id int, tx_amount double, tx_time_seconds int, tx_fraud int")).repartition(3).persist()
    rf = ml._rf_for_tuning("tx_fraud")
    maps = [{rf.numTrees: n, rf.maxDepth: d, rf.impurity: "entropy"} for n, d in ((4, 2), (4, 9), (1, 5), (4, 5), (1, 3))]
    fits = []
    fit = ml.RandomForestClassifier._fit
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", lambda est, df: (fits.append((est.getNumTrees(), est.getMaxDepth())), fit(est, df))[1])
    found = dict(rf.fitMultiple(df, maps))
    assert sorted(fits) == [(1, 5), (4, 9)] and sorted(found) == [0, 1, 2, 3, 4]
    for i, m in enumerate(maps):
        own = fit(rf.copy(m), df)
        assert found[i].getMaxDepth() == m[rf.maxDepth]
        assert found[i].toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
        a, b = ([r[0] for r in x.transform(df).select("rawPrediction").collect()] for x in (found[i], own))
        assert a == b
    df.unpersist()


def test_forests_too_wide_for_one_turn_are_fitted_on_their_own():
    rf = ml._rf_for_tuning("tx_fraud")
    assert rf._level_fits(400, 10, 4) and not rf._level_fits(400, 12, 4) and not rf._level_fits(400, 10, 40)


def test_searches_share_fits_and_list_the_same_metrics(spark, monkeypatch):
    """Both searches, with forests shared by depth and with each fitted on its own."""
    fits = []
    fit = ml.RandomForestClassifier._fit
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", lambda est, df: (fits.append(est.getMaxDepth()), fit(est, df))[1])
    monkeypatch.setattr(ml, "CV_SPACE", {"numTrees": [3], "maxDepth": [1, 2, 4], "impurity": ["gini"]})
    monkeypatch.setattr(ml, "SEARCH_SPACE", ml.CV_SPACE)
    df = planted(spark, 300).withColumn("tx_fraud", (F.col("terminal_id") + F.col("customer_id")) % 3 % 2)
    for run, folds in ((ml.tune_cv, 2), (ml.tune_random, 1)):
        found = []
        for least, own in ((0, 1), (1 << 40, 3)):
            monkeypatch.setattr(ml, "SHARED_DRAWS", least)
            fits.clear()
            found.append([tuple(r) for r in run(df, n_trials=4)[1].orderBy("trial").collect()])
            assert len(fits) == own * folds + 1
        assert found[0] == found[1] and len({r[7] for r in found[0]}) > 1


def test_a_failing_fit_ends_the_search(spark):
    """Threads that wait for the failed forest get its error, and none of them hangs."""
    df = ml.assembler().transform(planted(spark, 50).withColumn("tx_fraud", F.lit(-1)))
    rf = ml._rf_for_tuning("tx_fraud")
    found = rf.fitMultiple(df, [{rf.numTrees: 3, rf.maxDepth: d} for d in (2, 3)])
    for _ in range(2):
        try:
            next(found)
        except StopIteration:
            raise AssertionError("the error was lost") from None
        except Exception:
            continue
        raise AssertionError("no error")
