"""Rows-only queries checked against brute force on a small fixture (the sf0.001 feature
table, 31 rows): the k-prototypes fit (M6) and the Yeo-Johnson transform (F16)."""
import numpy as np
import pytest

from roadrisk import catalog
from roadrisk.plans import prediction as P

SF = "/root/testdata/sf0.001"
NUM = ["accidentes", "muertes", "heridos"]
CAT = ["HORARIO", "vulnerables"]


@pytest.fixture(scope="module")
def feats(spark):
    return catalog._features(spark, SF)


def _local(feats):
    rows = sorted(feats.collect(), key=lambda r: (r.MVINOMBRE, r.HORARIO))
    x = np.array([[float(r[c]) for c in NUM] for r in rows])
    mn, mx = x.min(axis=0), x.max(axis=0)
    rng = mx - mn
    xs = np.where(rng == 0, 0.0, (x - mn) / np.where(rng == 0, 1.0, rng))
    cats = [[r[c] for c in CAT] for r in rows]
    return xs, cats


def _brute_fit(xs, cats, k, n_restarts, seed=0, max_iter=100):
    n, p = xs.shape
    gamma = 0.5 * float(np.mean(xs.std(axis=0)))
    # Cao: density = mean relative frequency; ties -> first row in (name, block) order
    freq = [{} for _ in CAT]
    for c in cats:
        for a, v in enumerate(c):
            freq[a][v] = freq[a].get(v, 0) + 1
    dens = np.array([(freq[0][c[0]] / n + freq[1][c[1]] / n) / 2.0 for c in cats])
    chosen = []
    for _ in range(k):
        if not chosen:
            score = dens
        else:
            score = np.min([np.array([sum(a != b for a, b in zip(c, ch)) for c in cats]) * dens
                            for ch in chosen], axis=0)
        chosen.append(list(cats[int(np.argmax(score))]))
    mean, std = xs.mean(axis=0), xs.std(axis=0)
    results = []
    for r in range(n_restarts):
        num = mean + np.random.default_rng(seed + r).standard_normal((k, p)) * std
        cat = [list(c) for c in chosen]
        for it in range(1, max_iter + 1):
            d = np.array([[((xs[i] - num[j]) ** 2).sum()
                           + gamma * sum(a != b for a, b in zip(cats[i], cat[j])) for j in range(k)]
                          for i in range(n)])
            lab = d.argmin(axis=1)
            cost = float(d.min(axis=1).sum())
            new_num, new_cat = num.copy(), [list(c) for c in cat]
            for j in range(k):
                idx = np.where(lab == j)[0]
                if len(idx) == 0:
                    continue
                new_num[j] = xs[idx].mean(axis=0)
                for a in range(len(CAT)):
                    vals = [cats[i][a] for i in idx]
                    best = max(vals.count(v) for v in set(vals))
                    new_cat[j][a] = min(v for v in set(vals) if vals.count(v) == best)
            done = np.allclose(new_num, num, rtol=0, atol=1e-12) and new_cat == cat
            num, cat = new_num, new_cat
            if done:
                break
        results.append((cost, num, cat))
    return results


def test_kprototypes_fit_matches_brute_force(feats):
    xs, cats = _local(feats)
    best, summary = P.fit_model(feats, k=3, n_restarts=6)
    brute = _brute_fit(xs, cats, 3, 6)
    for s, (cost, _, _) in zip(summary, brute):
        assert abs(s["cost"] - cost) <= 1e-9 * max(1.0, cost)
    want = min(range(len(brute)), key=lambda r: (brute[r][0], r))
    assert best.restart == want
    assert np.allclose(np.array(best.centroids_num), brute[want][1], rtol=0, atol=1e-9)
    assert best.centroids_cat == brute[want][2]


def test_yeo_johnson_transform_matches_brute_force(feats):
    from roadrisk.functions.scaling import yeo_johnson_fit, yeo_johnson_transform
    params = {r.feature: r["lambda"] for r in yeo_johnson_fit(feats).collect()}
    out = sorted(yeo_johnson_transform(feats, yeo_johnson_fit(feats)).collect(),
                 key=lambda r: (r.MVINOMBRE, r.HORARIO))
    rows = sorted(feats.collect(), key=lambda r: (r.MVINOMBRE, r.HORARIO))
    for c in NUM:
        lam = params[c]
        x = np.array([float(r[c]) for r in rows])  # counts are >= 0
        psi = np.log1p(x) if abs(lam) < 1e-12 else ((x + 1.0) ** lam - 1.0) / lam
        z = (psi - psi.mean()) / psi.std() if psi.std() > 0 else np.zeros_like(psi)
        assert np.allclose([r[c] for r in out], z, rtol=0, atol=1e-9)
    # the chosen lambda maximises the profile log-likelihood over a wide grid (brute force)
    grid = np.round(np.arange(-2400, 1201) / 100.0, 10)
    for c in NUM:
        x = np.array([float(r[c]) for r in rows])
        ll = []
        for lam in grid:
            psi = np.log1p(x) if abs(lam) < 1e-12 else ((x + 1.0) ** lam - 1.0) / lam
            ll.append(round(-len(x) / 2.0 * np.log(psi.var()) + (lam - 1.0) * np.sum(np.log1p(x)), 6))
        assert abs(grid[int(np.argmax(ll))] - params[c]) < 1e-9


def test_power_transform_searches_past_its_first_grid(spark):
    """A left-skewed column whose best lambda is far outside [-3, 3]."""
    import numpy as np

    from roadrisk.functions.scaling import yeo_johnson_fit
    x = 10 - np.random.default_rng(3).gamma(1.0, 0.4, 400)
    df = spark.createDataFrame([(float(v),) for v in x], "accidentes double")
    got = yeo_johnson_fit(df, ["accidentes"]).first()

    def loglik(lam):
        psi = ((x + 1) ** lam - 1) / lam
        return -len(x) / 2 * np.log(psi.var()) + (lam - 1) * np.log1p(x).sum()

    lams = np.arange(1, 100, 0.01)
    assert got["lambda"] > 3 and abs(got["lambda"] - lams[np.argmax([loglik(v) for v in lams])]) < 0.02
