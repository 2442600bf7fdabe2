"""Native recursions and paths against the numpy ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import paths, recursion, regime, simulate

GIVEN = {"mu0": 0.05, "mu1": -0.2, "sigma0": 0.8, "sigma1": 2.5, "a0": 2.2, "b0": 0.7, "a1": -1.8, "b1": -0.3}


def numpy_filter(y, x, g):
    beta = np.array([[[g["a0"], g["b0"]], [g["a1"], g["b1"]]]])
    kept, _, _, loglik, _ = regime._expect(y, np.column_stack([np.ones(len(y)), x]), np.array([[g["mu0"], g["mu1"]]]), np.array([[g["sigma0"], g["sigma1"]]]), beta)
    return kept[0][:, 0], loglik[0]


def test_filter_equals_the_fitting_one(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for key, n, x_scale in (("a", 300, 0.0), ("b", 120, 1.0), ("one", 1, 1.0), ("far", 50, 30.0)):
        y, x = rng.normal(size=n) * 2, rng.normal(size=n) * x_scale
        want[key] = numpy_filter(y, x, GIVEN)
        rows += [(key, i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, x, strict=True))]
    rows += [("gap", 0, None, 1.0), ("a", 1_000, None, 0.0), ("wild", 0, 1e6, 0.0), ("wild", 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, i int, y double, x double").repartition(3)
    p = recursion.parameters(**GIVEN)
    own = recursion.series_of(df, "k", "i", "y", "x")
    out = {r["k"]: r for r in own.select("k", recursion.filtered_last(p, F.col("series")).alias("f"), recursion.filtered_path(p, F.col("series")).alias("path")).collect()}
    assert set(out) == {*want, "wild"}
    for key, (calm, loglik) in want.items():
        assert out[key]["path"] == pytest.approx(calm.tolist(), abs=1e-9)
        assert (out[key]["f"]["calm"], out[key]["f"]["loglik"]) == pytest.approx((calm[-1], loglik), abs=1e-7)
    assert 0 <= out["wild"]["f"]["calm"] <= 1  # an impossible observation leaves a probability
    empty = spark.range(1).select(recursion.filtered_last(p, F.array().cast("array<struct<y:double,x:double>>")).alias("f")).first()["f"]
    assert empty["calm"] is None and empty["loglik"] == 0


def test_matrices_and_their_check(spark):
    fit = regime.Fit(np.zeros(2), np.ones(2), np.array([[GIVEN["a0"], GIVEN["b0"]], [GIVEN["a1"], GIVEN["b1"]]]), np.ones((1, 2)) / 2, np.eye(2), 0.0, True, 1, True)
    days = spark.range(1).select(F.explode(F.transform(recursion.matrices(recursion.parameters(**GIVEN), F.lit(0.6), 4, 2.0), recursion.checked)).alias("m")).select("m.*").collect()
    for r in days:
        assert [[r["p00"], r["p01"]], [r["p10"], r["p11"]]] == pytest.approx(fit.matrix(0.6 * 0.5 ** (r["day"] / 2)))
    for bad in ((0.5, 0.4, 0.5, 0.5), (1.2, -0.2, 0.5, 0.5), (None, 0.5, 0.5, 0.5)):
        m = F.struct(*[F.lit(v).cast("double").alias(n) for v, n in zip(bad, ("p00", "p10", "p01", "p11"), strict=True)])
        with pytest.raises(Exception, match="sum to 1"):
            spark.range(1).select(recursion.checked(m)).collect()


def test_numbers_depend_on_their_place_alone(spark):
    small, large = (paths.numbers(spark, 7, n, 5).collect() for n in (50, 4_000))
    assert small == large[:50]
    z = np.array([[s["z"] for s in r["steps"]] for r in large])
    u = np.array([[r["first"], *(s["u"] for s in r["steps"])] for r in large])
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1) < 0.02 and 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    assert np.abs(np.corrcoef(np.column_stack([z, u]).T) - np.eye(11)).max() < 0.06
    assert paths.numbers(spark, 8, 1, 5).first()["first"] != small[0]["first"]
    with pytest.raises(ValueError):
        paths.numbers(spark, 1, 0, 5)


def test_paths_agree_with_the_drawn_ones(spark):
    cfg = simulate.Settings(paths=5_000)
    f = spark.createDataFrame([("g", 50.0, 0.1, 1.5), ("h", 10.0, -0.2, 3.0)], "k string, price double, mu double, sigma double")
    out = {r["k"]: r for r in paths.of_gbm(f, "k").collect()}
    for k, price, mu, sigma in (("g", 50.0, 0.1, 1.5), ("h", 10.0, -0.2, 3.0)):
        want = simulate.of_gbm(mu, sigma, price, cfg)
        for name, tolerance in (("p10", 0.004), ("p50", 0.004), ("p90", 0.006), ("prob_positive", 0.03), ("prob_drop_5pct", 0.03)):
            assert out[k][name] == pytest.approx(want[name], abs=tolerance)
    beta = np.array([[GIVEN["a0"], GIVEN["b0"]], [GIVEN["a1"], GIVEN["b1"]]])
    fit = regime.Fit(np.array([0.05, -0.2]), np.array([0.8, 2.5]), beta, np.array([[0.3, 0.7]]), np.eye(2), 0.0, True, 1, True)
    p = recursion.parameters(**GIVEN)
    g = spark.range(1).select(F.lit("x").alias("k"), F.lit(20.0).alias("price"), F.lit(0.3).alias("calm"), p.alias("p"), recursion.matrices(p, F.lit(0.4), 5, 2.0).alias("days"))
    got, want = paths.of_regimes(g, "k").first(), simulate.of_regimes(fit, 20.0, 0.4, cfg)
    for name, tolerance in (("p10", 0.006), ("p50", 0.004), ("p90", 0.006), ("prob_positive", 0.03), ("prob_drop_5pct", 0.03)):
        assert got[name] == pytest.approx(want[name], abs=tolerance)
    again = paths.of_regimes(g.repartition(3), "k").first()
    assert again == got
    with pytest.raises(Exception, match="price must be positive"):
        paths.of_gbm(f.withColumn("price", F.lit(0.0)), "k").collect()
    with pytest.raises(Exception, match="deviations percent"):
        paths.of_gbm(f.withColumn("sigma", F.lit(120.0)), "k").collect()
