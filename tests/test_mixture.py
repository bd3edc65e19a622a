import numpy as np
import pytest

from sigloom.operators import mixture


def frame(spark, points):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, vector array<double>")


@pytest.fixture(scope="module")
def points():
    draw = np.random.default_rng(8)
    middles = np.array([[0.0, 0.0, 5.0], [4.0, 4.0, 0.0], [-4.0, 4.0, 0.0]])
    return np.concatenate([m + draw.normal(0, s, (80, 3)) for m, s in zip(middles, (0.5, 1.0, 0.7), strict=True)])


def density(x, mean, cov):
    away = x - mean
    return np.exp(-0.5 * away @ np.linalg.inv(cov) @ away) / np.sqrt((2 * np.pi) ** len(x) * np.linalg.det(cov))


@pytest.mark.parametrize("covariance", ["diagonal", "tied"])
def test_step_equals_plain_em(spark, points, covariance):
    draw = np.random.default_rng(1)
    weights, means = np.array([0.2, 0.5, 0.3]), points[[0, 90, 200]]
    spread = draw.random((3, 3)) + 0.5 if covariance == "diagonal" else np.eye(3) + 0.2
    matrices = [np.diag(v) for v in spread] if covariance == "diagonal" else [spread] * 3
    model = mixture.Mixture(weights, means, spread, covariance)
    p = np.array([[w * density(x, m, c) for w, m, c in zip(weights, means, matrices, strict=True)] for x in points])
    r = p / p.sum(axis=1)[:, None]
    n = r.sum(axis=0)
    want = (r.T @ points) / n[:, None]
    away = [points - m for m in want]
    scatter = [(r[:, i, None] * a).T @ a for i, a in enumerate(away)]
    moments = points.T @ points if covariance == "tied" else None
    got, mean = mixture.mixture_step(frame(spark, points).repartition(5), model, np.zeros(3), moments)
    assert np.allclose(got.weights, n / n.sum()) and np.allclose(got.means, want)
    assert np.isclose(mean, np.log(p.sum(axis=1)).mean())
    if covariance == "tied":
        assert np.allclose(got.spread, sum(scatter) / n.sum())
    else:
        assert np.allclose(got.spread, [np.diag(s) / k for s, k in zip(scatter, n, strict=True)])


@pytest.mark.parametrize("covariance", ["diagonal", "tied"])
def test_planted_groups_are_found(spark, points, covariance, tmp_path):
    df = frame(spark, points)
    model = mixture.fit_gmm(df, 3, 60, 4, covariance=covariance)
    assert all(b >= a - 1e-9 for a, b in zip(model.history, model.history[1:]))
    mixture.save_mixture(model, spark, str(tmp_path / "m"))
    again = mixture.load_mixture(spark, str(tmp_path / "m"))
    placed = mixture.mixture_assign(df, again, ["id"]).collect()
    groups = [{r.cluster for r in placed if r.id // 80 == g} for g in range(3)]
    assert sorted(len(g) for g in groups) == [1, 1, 1] and len(set.union(*groups)) == 3
    assert all(0.5 < r.probability <= 1 for r in placed)


def test_more_components_than_dimensions_allow_for_full_covariances(spark, points):
    df = frame(spark, np.concatenate([points, points[:20]]))
    model = mixture.fit_gmm(df, 100, 10)
    assert model.means.shape == (100, 3) and np.isclose(model.weights.sum(), 1) and (model.spread > 0).all()
    assert mixture.mixture_assign(df, model, ["id"]).filter("cluster between 0 and 99 and probability > 0").count() == 260
    few = mixture.fit_gmm(frame(spark, [[1.0, 2.0]] * 5), 4, 3)
    assert few.means.tolist() == [[1.0, 2.0]]
    with pytest.raises(ValueError):
        mixture.fit_gmm(df, 2, covariance="full")
