import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorlake.operators import boosting, model
from tremorlake.operators.metrics import three_metrics
from tremorlake.plans import training
from tremorlake.schema import FEATURES, TARGET

SMALL = model.GbtParams(n_estimators=5, max_depth=2, subsample=1.0, colsample=1.0, min_child_weight=1, gamma=0.0)


@pytest.fixture(scope="module")
def table(spark):
    n = 240
    signal = F.rand(50) * 10
    return (
        spark.range(n)
        .withColumn("signal", signal)
        .select(
            F.floor(F.col("id") / 4).cast("string").alias("mainshock_id"),
            F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 4) * 7200).alias("mainshock_time"),
            (F.col("id") % 4).cast("int").alias("snapshot_hours"),
            *[
                (F.col("signal") if f == "mainshock_magnitude" else F.rand(i) * 10)
                .cast("int" if f == "zona_sesar" else "double")
                .alias(f)
                for i, f in enumerate(FEATURES)
            ],
            (F.col("signal") > 7.5).cast("int").alias(TARGET),
        )
        .cache()
    )


@pytest.fixture(scope="module")
def parts(table):
    return training.prepare_train_test(table)


def test_split_is_by_time(parts):
    train, test = parts
    total = train.count() + test.count()
    assert 0.70 <= train.count() / total <= 0.80 and test.count() > 0
    assert train.agg(F.max("mainshock_time")).first()[0] <= test.agg(F.min("mainshock_time")).first()[0]


def test_split_without_time(table):
    rows = table.drop("mainshock_time")
    train, test = training.prepare_train_test(rows)
    assert (train.count(), test.count()) == (180, 60)
    with pytest.raises(ValueError, match="zona_sesar"):
        training.prepare_train_test(table.drop("zona_sesar"))


def test_resampling_raises_the_share(parts):
    train, _ = parts
    before = train.agg(F.avg(TARGET)).first()[0]
    after = training.resampled_train(train).agg(F.avg(TARGET)).first()[0]
    assert before < after and 0.10 < after < 0.90


def test_model_learns_stores_and_scores(spark, parts, tmp_path):
    train, test = parts
    fitted = model.train_gbt(train, SMALL)
    model.save_model(fitted, str(tmp_path / "m"), 0.4, spark)
    loaded, threshold = model.load_model(str(tmp_path / "m"), spark)
    assert threshold == 0.4
    scored = model.batch_score(loaded, test, threshold)
    assert scored.count() == test.count()
    assert scored.filter("proba < 0 or proba > 1 or proba is null").count() == 0
    assert scored.filter("prediction != cast(proba >= 0.4 as int)").count() == 0
    metrics = three_metrics(scored, threshold).first()
    assert all(0.0 <= m <= 1.0 for m in metrics) and metrics.pr_auc > 0.9
    importance = model.feature_importance(loaded, spark).collect()
    assert importance[0].feature == "mainshock_magnitude" and len(importance) == 10
    assert abs(sum(r.importance for r in importance) - 1.0) < 1e-9


def plain_forest(values, labels, keys, params, seed):
    """The same objective on lists: every cut between two values of every feature, in every node."""
    n, features = values.shape
    base = (labels.sum() - n / 2) / (n / 4)
    edges = []
    for column in values.T:
        order = np.sort(column[~np.isnan(column)])
        places = {}
        for v in order:
            place = int(np.sum(order < v)) * (boosting.MISSING - 1) // len(order)
            places[place] = min(v, places.get(place, v))
        edges.append([places[p] for p in sorted(places)][1:])
    margin, trees = np.full(n, base), []
    for t in range(params.n_estimators):
        growth = boosting.Growth(params, base, features, seed, trees=[None] * t)
        chance = 1 / (1 + np.exp(-margin))
        drawn = growth.drawn(keys.view(np.uint64))
        g, h = (np.rint(x * boosting.UNIT) * drawn / boosting.UNIT for x in (chance - labels, chance * (1 - chance)))
        tree, moved = {}, np.zeros(n)

        def grow(node, rows, depth, g=g, h=h, growth=growth, tree=tree, moved=moved):
            G, H = g[rows].sum(), h[rows].sum()
            best = None
            for f in growth.columns() if depth < params.max_depth else ():
                x = values[rows, f]
                for cut in [*edges[f], np.inf]:
                    for side in (False, True):
                        left = np.where(np.isnan(x), side, x < cut)
                        a, b = g[rows[left]].sum(), h[rows[left]].sum()
                        if min(b, H - b) < max(params.min_child_weight, 1 / boosting.UNIT):
                            continue
                        gain = a * a / (b + 1) + (G - a) ** 2 / (H - b + 1) - G * G / (H + 1)
                        if gain > 1e-6 and gain >= params.gamma and (best is None or gain > best[0] + 1e-12):
                            best = gain, f, cut, side, left
            if best is None:
                tree[node] = (None, None)
                moved[rows] = -G / (H + 1) * params.learning_rate
            else:
                tree[node] = best[1], best[2]
                grow(2 * node + 1, rows[best[4]], depth + 1)
                grow(2 * node + 2, rows[~best[4]], depth + 1)

        every = np.arange(n)
        grow(0, every, 0)
        # Rows that were not drawn move as well; they have no gradients, so they change no sum.
        margin = margin + moved
        trees.append(tree)
    return trees, margin


@pytest.mark.parametrize(
    "params",
    [
        model.GbtParams(6, 3, 0.3, 1.0, 1.0, 1, 0.0),
        model.GbtParams(5, 4, 0.1, 0.7, 0.6, 3, 0.5),
        model.GbtParams(3, 2, 0.5, 1.0, 1.0, 40, 2.0),
    ],
)
def test_trees_equal_plain_ones(spark, params):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(500, 4)), 1)
    x[rng.random(500) < 0.2, 2] = np.nan
    y = ((x[:, 0] + np.nan_to_num(x[:, 2], nan=1.0) + rng.normal(size=500) * 0.5) > 0.4).astype(int)
    rows = [(*(None if np.isnan(v) else float(v) for v in r), int(t)) for r, t in zip(x, y)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double, y int")
    keyed = table.select("*", F.xxhash64(*table.columns).alias("key")).collect()
    fitted = model.train_gbt(table, params, list("abcd"), "y", seed=3)
    values = np.array([[np.nan if v is None else v for v in r[:4]] for r in keyed], float)
    trees, margin = plain_forest(values, np.array([r.y for r in keyed]), np.array([r.key for r in keyed]), params, 3)
    found = [{} for _ in trees]
    for r in fitted.nodes.to_pylist():
        found[r["tree"]][r["node"]] = (None, None) if r["feature"] is None else ("abcd".index(r["feature"]), r["threshold"])
    assert found == trees
    got = table.select(fitted.margin(*map(F.col, "abcd")).alias("m")).collect()
    assert np.allclose([r.m for r in got], margin, atol=1e-9)


def test_levels_as_jobs_give_the_same_trees(spark, parts, monkeypatch):
    """Rows that stay in their tasks, in many parts, with margins written in between, and both configurations together."""
    monkeypatch.setattr(boosting, "WRITTEN_EVERY", 2)
    train = parts[0].repartition(7)
    two = [SMALL, model.GbtParams(n_estimators=4, max_depth=3, subsample=0.7, colsample=0.5, min_child_weight=2, gamma=0.1)]
    whole = model.train_models(train, two)
    apart = model.train_models(train, two, task_rows=10)
    assert all(a.nodes.equals(b.nodes) and a.base == b.base for a, b in zip(whole, apart))
    assert whole[1].nodes.equals(model.train_gbt(train, two[1]).nodes)


def test_sql_of_a_model(spark, parts):
    import duckdb

    train, test = parts
    fitted = model.train_gbt(train, SMALL)
    rows = test.select(*[F.when(F.rand(1) < 0.9, F.col(f)).alias(f) for f in FEATURES]).toPandas()
    table = spark.createDataFrame(rows)
    want = [r.m for r in table.select(fitted.margin(*[F.col(f).cast("double") for f in FEATURES]).alias("m")).collect()]
    assert np.allclose([r.m for r in table.select(F.expr(fitted.sql()).alias("m")).collect()], want)
    clean = rows.astype(object).where(rows.notna(), None)
    con = duckdb.connect()
    con.register("rows_", clean.astype(float))
    found = con.execute(f"SELECT {fitted.sql()} AS m FROM (SELECT {', '.join(f'CASE WHEN isnan({f}) THEN NULL ELSE {f} END AS {f}' for f in FEATURES)} FROM rows_)").fetchall()
    assert np.allclose([m for (m,) in found], want)


def test_degenerate_tables(spark):
    one_class = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 1), (3.0, None)], "a double, y int")
    fitted = model.train_gbt(one_class, SMALL, ["a"], "y")
    assert fitted.nodes.column("node").to_pylist() == [0] * 5
    with pytest.raises(ValueError, match="no rows"):
        model.train_gbt(one_class.limit(0), SMALL, ["a"], "y")


def test_lone_class_is_trained_on(spark, table):
    """Balancing leaves it alone, and every step after it gives its rows: trees of one leaf, equal scores."""
    train, test = training.prepare_train_test(table.withColumn(TARGET, F.lit(1)))
    balanced = training.resampled_train(train)
    assert balanced.count() == train.count() and balanced.filter("synthetic").isEmpty()
    runs, models = training.run_variations(train, test, [model.Variation("one", SMALL, 0.45)])
    assert [(r.pr_auc, r.f1_score, r.recall) for r in runs.collect()] == [(1.0, 1.0, 1.0)]
    (fitted,) = models.values()
    scored = model.batch_score(fitted, test).collect()
    assert len(scored) == test.count() and len({r.proba for r in scored}) == 1 and {r.prediction for r in scored} == {1}
    shares = model.feature_importance(fitted, spark).collect()
    assert sorted(r.feature for r in shares) == sorted(FEATURES) and {r.importance for r in shares} == {0.0}


def test_variations_share_models(parts):
    variations = [
        model.Variation("one", SMALL, 0.45), model.Variation("two", SMALL, 0.40),
    ]
    runs, models = training.run_variations(*parts, variations)
    rows = {r.run_name: r for r in runs.collect()}
    assert len(models) == 1 and set(rows) == {"one", "two"}
    assert rows["one"].pr_auc == rows["two"].pr_auc
    assert rows["two"].recall >= rows["one"].recall
    assert rows["two"].params["threshold"] == "0.4" and rows["two"].params["resampling"] == "SMOTETomek"
    plain, _ = training.run_variations(*parts, variations[:1], balance=False)
    (row,) = plain.collect()
    assert row.params["resampling"] == "none" and row.run_id not in {r.run_id for r in rows.values()}
