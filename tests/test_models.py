"""Fitted models against independent NumPy fits."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerpulse.operators import churn_model, sampling, survival, text_model


def logistic_newton(x, y, w, l2=1.0):
    """Weighted L2 logistic regression with a free intercept."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([0.0] + [l2] * x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + ridge,
                               design.T @ (w * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-12:
            return beta
    raise AssertionError("no convergence")


@pytest.fixture(scope="module")
def accounts(spark):
    rng = np.random.default_rng(3)
    n = 300
    freq = rng.poisson(4, n) + 1
    money = np.round(rng.gamma(2, 100, n), 2)
    tenure = rng.integers(0, 600, n)
    y = (rng.random(n) < 1 / (1 + np.exp(0.4 * (freq - 4) - 0.2))).astype(int)
    rows = [
        (i, int(f), float(m), float(m / f), float(t), int(c))
        for i, (f, m, t, c) in enumerate(zip(freq, money, tenure, y))
    ]
    return spark.createDataFrame(
        rows, "customer_id int, frequency long, monetary double, avg_order_value double, tenure_days double, churned int"
    ).cache()


def test_churn_model_equals_newton(accounts):
    model = churn_model.churn_model(accounts)
    pdf = accounts.toPandas()
    x = pdf[list(churn_model.FEATURES)].to_numpy(float)
    z = (x - x.mean(0)) / x.std(0)
    y = pdf["churned"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = logistic_newton(z, y, w)
    got = model.coefficients()
    assert [got[f] for f in churn_model.FEATURES] == pytest.approx(beta[1:], abs=1e-5)
    assert list(got.values()) == sorted(got.values())
    want = 1 / (1 + np.exp(-(beta[0] + z @ beta[1:])))
    scored = model.score(accounts).orderBy("customer_id").toPandas()
    assert scored["churn_probability"].to_numpy() == pytest.approx(want, abs=1e-5)
    assert (scored["churn_pred"].to_numpy() == (want > 0.5)).all()


def test_missing_features_count_as_zero(accounts):
    model = churn_model.churn_model(accounts)
    one = accounts.limit(1)
    a, b = (
        model.score(one.withColumn("avg_order_value", v.cast("double"))).first()["churn_probability"]
        for v in (F.lit(None), F.lit(0.0))
    )
    assert a == b


def test_split_is_exact_seeded_and_independent_of_partitions(accounts):
    one = sampling.split_by_class(accounts, "churned", "customer_id", 0.2)
    counts = {(r["churned"], r["split"]): r["count"] for r in one.groupBy("churned", "split").count().collect()}
    sizes = {c: counts[c, "train"] + counts[c, "test"] for c in (0, 1)}
    train = sampling.train_sizes(sizes, 0.2)
    assert {c: counts[c, "train"] for c in (0, 1)} == train
    assert sum(counts[c, "test"] for c in (0, 1)) == 60

    def chosen(df, seed=42):
        out = sampling.split_by_class(df, "churned", "customer_id", 0.2, seed)
        return {r["customer_id"] for r in out.filter("split = 'test'").collect()}

    assert chosen(accounts) == chosen(accounts.repartition(7)) != chosen(accounts, 1)


def test_resample_repeats_rows_and_keeps_sizes(spark):
    pool = spark.range(5).withColumnRenamed("id", "k")
    draws = sampling.resample(pool, "k", [1, 2], 40).collect()
    assert sorted({r["group"] for r in draws}) == [1, 2] and len(draws) == 80
    assert {r["k"] for r in draws} == set(range(5))
    again = sampling.resample(pool.repartition(3), "k", [1, 2], 40).collect()
    assert sorted(draws) == sorted(again)


def test_shuffle_keeps_all_rows(spark):
    ids = [r["id"] for r in sampling.seeded_shuffle(spark.range(50), "id").collect()]
    assert sorted(ids) == list(range(50)) != ids


TEXTS = [
    ("pay my bill please", "pay"), ("pay the water bill", "pay"), ("bill is due", "due"), ("when is the bill due", "due"),
    ("where is my bag", "bag"), ("my bag is lost", "bag"), ("lost bag at the airport", "bag"), ("pay bill", "pay"),
]


def hand_tfidf(texts, stop):
    docs = []
    for text, _ in texts:
        words = [w for w in text.split() if len(w) > 1 and w not in stop]
        docs.append(words + [" ".join(p) for p in zip(words, words[1:])])
    terms = sorted({t for d in docs for t in d})
    df = {t: sum(t in d for d in docs) for t in terms}
    rows = []
    for d in docs:
        raw = np.array([d.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in terms])
        rows.append(raw / np.linalg.norm(raw))
    return terms, np.array(rows)


def test_tfidf_by_hand(spark):
    stop = ["is", "the", "my", "at", "when", "where"]
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(TEXTS)], "id int, text string, intent_name string")
    stages = text_model.tfidf_stages(df, stop_words=stop)
    terms, want = hand_tfidf(TEXTS, stop)
    assert stages.stages[1].vocabulary == terms
    got = np.zeros_like(want)
    for r in text_model.tfidf_long(stages, df, "id").collect():
        got[r["id"], terms.index(r["term"])] = r["weight"]
    assert got == pytest.approx(want, abs=1e-12)


def test_vocabulary_limit_breaks_ties_by_term(spark):
    df = spark.createDataFrame([("bb aa cc aa",)], "text string")
    assert text_model.tfidf_stages(df, ngrams=1, terms=2, stop_words=[]).stages[1].vocabulary == ["aa", "bb"]


def test_weights_are_fitted_on_kept_counts(spark, monkeypatch):
    seen, real = [], text_model.weight_stages
    monkeypatch.setattr(text_model, "weight_stages", lambda counted: seen.append((counted.columns, counted.storageLevel.useDisk)) or real(counted))
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(TEXTS)], "id int, text string, intent_name string")
    text_model.intent_model(df, max_iter=2)
    assert seen == [(["intent_name", "_counts"], True)]


def test_intent_model_equals_gradient_descent(spark):
    stop = ["is", "the", "my", "at", "when", "where"]
    df = spark.createDataFrame(TEXTS, "text string, intent_name string")
    model = text_model.intent_model(df, stop_words=stop, tol=1e-12)
    _, x = hand_tfidf(TEXTS, stop)
    labels = sorted({c for _, c in TEXTS})
    y = np.eye(len(labels))[[labels.index(c) for _, c in TEXTS]]
    w = (len(TEXTS) / (len(labels) * y.sum(0)))[y.argmax(1)][:, None]
    coef, bias = np.zeros((x.shape[1], len(labels))), np.zeros(len(labels))
    for _ in range(20000):
        z = np.exp(x @ coef + bias)
        gap = w * (z / z.sum(1, keepdims=True) - y)
        coef -= 0.1 * (x.T @ gap + coef)
        bias -= 0.1 * gap.sum(0)
    z = np.exp(x @ coef + bias)
    want = z / z.sum(1, keepdims=True)
    rows = {r["text"]: r for r in model.classify(df).collect()}
    assert model.labels == labels
    for (text, _), p in zip(TEXTS, want):
        assert rows[text]["pred"] == labels[p.argmax()]
        assert rows[text]["confidence"] == pytest.approx(p.max(), abs=1e-5)


def efron_newton(t, e, x, l2):
    """Direct loop over death times; penalty n * l2 / 2 on scaled covariates."""
    dev = x.std(0, ddof=1)
    z = (x - x.mean(0)) / dev
    n, p = z.shape
    beta = np.zeros(p)
    for _ in range(50):
        w = np.exp(z @ beta)
        grad, hess = np.zeros(p), np.zeros((p, p))
        for day in np.unique(t[e == 1]):
            risk, dead = t >= day, (t == day) & (e == 1)
            d = dead.sum()
            grad += z[dead].sum(0)
            for k in range(d):
                phi = w[risk].sum() - k / d * w[dead].sum()
                m = (w[risk] @ z[risk] - k / d * (w[dead] @ z[dead])) / phi
                s = ((z[risk] * w[risk][:, None]).T @ z[risk] - k / d * (z[dead] * w[dead][:, None]).T @ z[dead]) / phi
                grad -= m
                hess += s - np.outer(m, m)
        step = np.linalg.solve(hess + n * l2 * np.eye(p), grad - n * l2 * beta)
        beta += step
        if np.abs(step).max() < 1e-12:
            return beta / dev
    raise AssertionError("no convergence")


@pytest.mark.parametrize("l2", [0.1, 0.0])
def test_cox_equals_a_direct_efron_fit(spark, l2, monkeypatch):
    # Short stretches, so that tied deaths really are unfolded in several.
    monkeypatch.setattr(survival, "_STRETCH", 3)
    rng = np.random.default_rng(5)
    n = 200
    x = np.column_stack([rng.poisson(5, n), rng.gamma(2, 2, n)]).astype(float)
    t = np.ceil(rng.exponential(20 * np.exp(0.1 * x[:, 0]), n) / 5) * 5
    e = (rng.random(n) < 0.7).astype(int)
    df = spark.createDataFrame(
        [(float(a), int(b), float(c), float(d)) for a, b, (c, d) in zip(t, e, x)], "t double, e int, a double, b double"
    )
    model = survival.cox_fit(df, "t", "e", ["a", "b"], l2=l2)
    assert list(model.coefficients.values()) == pytest.approx(efron_newton(t, e, x, l2), abs=1e-8)
    ratios = {r["covariate"]: r["hazard_ratio"] for r in model.hazard_ratios(df).collect()}
    assert ratios["a"] == pytest.approx(math.exp(model.coefficients["a"]))


def test_cox_without_events(spark):
    df = spark.createDataFrame([(1.0, 0, 1.0), (2.0, 0, 2.0)], "t double, e int, a double")
    with pytest.raises(ValueError, match="no event"):
        survival.cox_fit(df, "t", "e", ["a"])


def test_kaplan_meier_by_hand(spark):
    rows = [(1, 1), (2, 0), (3, 1), (3, 1), (4, 0), (5, 1)]
    df = spark.createDataFrame([(float(t), e) for t, e in rows], "observed_days double, churned int")
    km = survival.kaplan_meier(df).collect()
    assert [r["at_risk"] for r in km] == [6, 5, 4, 2, 1]
    assert [r["survival"] for r in km] == pytest.approx([5 / 6, 5 / 6, 5 / 12, 5 / 12, 0])
    assert all(r["lower"] <= r["survival"] <= r["upper"] for r in km)
    assert survival.median_survival(survival.kaplan_meier(df)).first()[0] == 3.0
    never = df.withColumn("churned", F.lit(0))
    assert survival.median_survival(survival.kaplan_meier(never)).first()[0] is None


def test_covariates_are_clipped(spark):
    features = spark.createDataFrame([(1.0, 1, 2, -5.0)], "observed_days double, churned int, frequency int, monetary double")
    assert survival.cox_covariates(features).first()["monetary_root4"] == pytest.approx(0.01**0.25)


def test_terms_are_scored_where_the_weights_lie(spark):
    weights = spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", 2.0), (2, "zz", 1.0), (3, "b", -1.0), (None, "a", 1.0)], "id bigint, term string, weight double"
    )
    coefficients = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", -1.0), ("b", "y", 0.25)], "term string, label string, b double"
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = text_model.classify_terms(weights, "id", coefficients, ["y", "x"], {"y": 0.1})
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = {r["id"]: (r["pred"], r["confidence"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = {1: (0.5, 0.1), 2: (0.0, 0.1), 3: (0.0, -0.15), None: (1.0, -0.9)}  # x, y
    for key, (x, y) in want.items():
        assert found.pop(key) == ("x" if x >= y else "y", pytest.approx(1 / (1 + math.exp(-abs(x - y)))))
    assert not found
    assert "SortMergeJoin" not in plan and "Union" not in plan
