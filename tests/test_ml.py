import numpy as np
import pytest
from pyspark.sql import functions as F

from remitlens.contracts import DIMS, ML_NUMERIC
from remitlens.operators import ml, ml_report

SCHEMA = (
    "year int, week int, payer string, group_em string, group_em2 string, payment_amount double, "
    + ", ".join(f"{c} double" for c in ML_NUMERIC)
)


def weekly_rows(n=240, seed=3):
    """Payment depends on payer and expected payment; one numeric column is empty."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        payer = [None, "A", "B"][i % 3]
        visits = float(rng.integers(0, 5)) if i % 29 == 0 else float(rng.integers(1, 6))
        numeric = {c: float(rng.normal()) for c in ML_NUMERIC}
        numeric.update(visit_count=visits, radiology_count=None, labs_per_visit=None if i % 7 == 0 else float(i % 4))
        numeric["expected_payment"] = float(rng.normal(100, 30))
        rate = 20 + 0.5 * numeric["expected_payment"] + (40 if payer == "A" else 0) + float(rng.normal())
        rows.append((2020 + i // 104, 1 + (i // 2) % 52, payer, "g" + str(i % 2), "h", rate * visits, *[numeric[c] for c in ML_NUMERIC]))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(weekly_rows(), SCHEMA).cache()


def test_features(spark, table):
    rows = ml.model_rows(table)
    assert rows.filter("visit_count = 0").count() == 0
    features = ml.fit_features(rows)
    assert "radiology_count" not in features.medians
    labs = [r.labs_per_visit for r in rows.collect() if r.labs_per_visit is not None]
    assert features.medians["labs_per_visit"] == float(np.median(labs))
    names = features.names(rows)
    assert len(names) == 12 + 3 + 2 + 1 and {"payer_A", "payer_nan", "group_em_g1"} <= set(names)
    unseen = rows.limit(1).withColumns({"payer": F.lit("new"), "group_em": F.lit("new"), "group_em2": F.lit("new")})
    vector = features.transform(unseen).first().features.toArray()
    assert len(vector) == len(names) and not vector[12:].any()


def elastic_net_by_hand(x, y, alpha, ratio, sweeps=4000):
    """Coordinate descent for 1/(2n) |y - b - xw|² + alpha (ratio |w|₁ + (1 - ratio)/2 |w|²)."""
    xc, yc = x - x.mean(0), y - y.mean()
    n, w = len(y), np.zeros(x.shape[1])
    norms = (xc**2).sum(0) / n
    residual = yc.copy()
    for _ in range(sweeps):
        for j in range(x.shape[1]):
            if norms[j] == 0:
                continue
            rho = xc[:, j] @ residual / n + norms[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (norms[j] + alpha * (1 - ratio))
            residual += xc[:, j] * (w[j] - new)
            w[j] = new
    return w, y.mean() - x.mean(0) @ w


def dense(rows, medians):
    """Imputed and one-hot features in plain Python: (matrix, names, target)."""
    data = rows.orderBy("year", "week", "payer", "group_em", "group_em2").collect()
    cats = {c: sorted({getattr(r, c) or "nan" for r in data}) for c in DIMS}
    numbers = [c for c in ML_NUMERIC if medians[c] is not None]
    x = [
        [medians[c] if getattr(r, c) is None else getattr(r, c) for c in numbers]
        + [float((getattr(r, c) or "nan") == level) for c in DIMS for level in cats[c]]
        for r in data
    ]
    return np.array(x), numbers + [(c, level) for c in DIMS for level in cats[c]], np.array([r[ml.TARGET] for r in data])


def test_elastic_net_equals_coordinate_descent_on_rows(table):
    rows = ml.model_rows(table)
    model = ml.fit_elasticnet(rows)
    medians = ml.exact_medians(rows, ML_NUMERIC).first().asDict()
    x, names, y = dense(rows, medians)
    w, b = elastic_net_by_hand(x, y, 0.1, 0.2)
    ours = [model.linear.weights[n] if isinstance(n, str) else model.linear.levels[n[0]][n[1]] for n in names]
    assert np.abs(ours - w).max() < 1e-8 and model.linear.intercept == pytest.approx(b, abs=1e-7)
    assert "radiology_count" not in model.linear.weights
    # The optimum's own condition: gradients at most the penalty, equal to it where a weight is not zero.
    gradient = (x - x.mean(0)).T @ (y - x @ w - b) / len(y) - 0.1 * 0.8 * np.array(ours)
    assert np.all(np.abs(gradient) <= 0.02 + 1e-7)
    assert np.allclose(gradient[np.array(ours) != 0], 0.02 * np.sign(ours)[np.array(ours) != 0], atol=1e-7)
    unseen = rows.limit(1).withColumns({"payer": F.lit("new"), "visit_count": F.lit(None).cast("double")}).drop("labs_per_visit")
    (r,) = model.predict(unseen).collect()
    assert r.ml_expected_rate_per_visit is not None and "labs_per_visit" not in unseen.columns


def test_elastic_folds_equal_separate_fits(table):
    folds, final, placed = ml.elastic_cv(table, k=3)
    apart = ml.time_cv(table, ml.fit_elasticnet, k=3)
    got, want = ([tuple(r) for r in f.orderBy("fold").collect()] for f in (folds, apart))
    assert [g[0] for g in got] == [1, 2, 3]
    assert np.allclose(got, want, rtol=1e-9)
    assert final.linear.intercept == pytest.approx(ml.fit_elasticnet(ml.model_rows(table)).linear.intercept, rel=1e-9)
    assert placed.count() == ml.model_rows(table).count()


def test_folds_read_rows_a_fixed_number_of_times(spark, table):
    """Gaps, two scans for medians and one for statistics, whatever the number of folds."""
    read = {}
    for k in (2, 6):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = ml.model_rows(table).withColumn("block", F.col("week") % k)
        n = rows.count()
        watched = rows.mapInArrow(counted, rows.schema)
        ml._elastic_prefixes(watched, k, 0.1, 0.2)
        read[k] = seen.value / n
    assert read == {2: 4.0, 6: 4.0}


def test_too_many_category_values(table, monkeypatch):
    monkeypatch.setattr(ml.elastic, "MAX_LEVELS", 2)
    with pytest.raises(ValueError, match="category values"):
        ml.fit_elasticnet(ml.model_rows(table))


def test_scores_cover_the_whole_table(table):
    scored = ml.score(table, ml.fit_elasticnet).collect()
    assert len(scored) == 240
    for r in scored:
        if r.visit_count == 0:
            assert r.ml_expected_rate_per_visit is None and r.ml_material_gap_flag is None
        else:
            assert r.ml_dollar_gap == pytest.approx((r.payment_amount / r.visit_count - r.ml_expected_rate_per_visit) * r.visit_count)
            assert r.ml_material_gap_flag == int(abs(r.ml_rate_gap) >= 10)


def test_boosted_model_and_importance(table):
    rows = ml.model_rows(table)
    model = ml.fit_boosted(rows, iters=15, lr=0.3, depth=3)
    fit = ml_report.regression_metrics(model.predict(rows), ml.TARGET, model.predicted).first()
    assert fit.r2 > 0.8
    top = ml.feature_importance(model, rows).collect()
    assert len(top) == 18 and {top[0].feature, top[1].feature} == {"expected_payment", "payer_A"}
    with pytest.raises(ValueError):
        ml.feature_importance(ml.fit_elasticnet(rows), rows)


def test_folds_train_on_the_past_only(spark, table):
    seen = []

    def fit(train):
        bounds = train.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count("*").alias("n")).first()
        seen.append(tuple(bounds))
        return ml.fit_elasticnet(train)

    folds = ml.time_cv(table, fit, k=3).orderBy("fold").collect()
    n = ml.model_rows(table).count()
    size = n // 4
    assert [s[1] + 1 for s in seen] == [n - 3 * size, n - 2 * size, n - size]
    assert all(lo == 0 and count == hi + 1 for lo, hi, count in seen)
    assert [f.fold for f in folds] == [1, 2, 3] and all(f.r2 > 0.5 for f in folds)
    with pytest.raises(ValueError):
        ml.time_cv(table.limit(3), fit, k=5)


def test_metrics_record(spark, table):
    rows = ml.model_rows(table)
    model = ml.fit_elasticnet(rows)
    folds = spark.createDataFrame([(2, 3.0, 4.0, 0.5), (1, 1.0, 2.0, 0.7)], "fold int, mae double, rmse double, r2 double")
    record = ml.metrics_record(folds, model.score(rows), model).first()
    assert [f.fold for f in record.folds] == [1, 2]
    assert record.cross_validation.mae_mean == 2.0 and record.cross_validation.mae_std == pytest.approx(2**0.5)
    assert record.params.alpha == 0.1 and record.rows_used_for_model == rows.count() and record.train_fit.r2 > 0.9
    assert ml_report.fold_summary(folds.limit(1)).first().r2_std == 0.0


def test_linear_diagnostics(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(c), float(c * (0.5 + 0.001 * c))) for i, c in enumerate(rng.integers(0, 300, 400))]
    lines = spark.createDataFrame(rows, "row_id bigint, charge_amount double, payment_amount double")
    scored, metrics = ml.linear_diagnostics(lines)
    m = metrics.first()
    assert m.r2 > 0.999 and 40 < m.test_samples < 130 and m.features_used == ["charge_amount"]
    assert m.training_samples + m.test_samples == sum(c > 0 for _, c, _ in rows)
    out = scored.collect()
    assert len(out) == 400 and all((r.payment_rate is None) == (r.charge_amount == 0) for r in out)
    assert all(r.ml_expected_rate == pytest.approx(0.5 + 0.001 * r.charge_amount) for r in out)
    few, none = ml.linear_diagnostics(lines.limit(5))
    assert few.count() == 5 and none.count() == 0 and few.first().ml_expected_rate is None
    assert none.schema.simpleString() == metrics.schema.simpleString()


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 2.0, 2.0), ("b", 2.0, 2.0), ("c", 1.0, 5.0), ("d", 1.0, 2.0), ("d", 1.0, 1.0), ("a", None, 1.0)], "k string, y double, p double")
    got = {r.k: r for r in ml_report.regression_metrics(df, "y", "p", ["k"]).collect()}
    assert (got["a"].mae, got["a"].rmse, got["a"].r2) == (0.5, pytest.approx(0.5**0.5), 0.5)
    assert (got["b"].r2, got["c"].r2, got["d"].r2) == (1.0, None, 0.0)


def test_column_families(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1, 5.0, 6.0, 0)], "hgb_rate_gap double, hgb_dollar_gap double, hgb_material_gap_flag int, ml_rate_gap double, ml_dollar_gap double, ml_material_gap_flag int")
    assert ml_report.ml_columns(df)["dollar_gap"] == "hgb_dollar_gap"
    assert ml_report.ml_columns(df.drop("hgb_dollar_gap"))["dollar_gap"] == "ml_dollar_gap"
    assert ml_report.ml_columns(df.select("ml_rate_gap")) is None
    assert tuple(ml_report.ml_totals(df).first()) == (2.0, 1)
    with pytest.raises(ValueError):
        ml_report.ml_totals(df.select("ml_rate_gap"))
    assert tuple(ml_report.ml_totals(df.drop("hgb_material_gap_flag")).first()) == (2.0, None)
    for n in (0, -1):
        with pytest.raises(ValueError):
            ml_report.ml_hotspots_topn(df, n)


def test_finite_target(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "y double")
    assert [r.y for r in ml_report.finite_target(df, "y").collect()] == [1.0, float("-inf")]
