"""k-prototypes on a hand-computed 6-row fixture, plus fit invariants."""
import pytest

from roadrisk.operators import kproto as K

ROWS = [(0, 0.0, 0.0, "a", "p"), (1, 0.1, 0.0, "a", "p"), (2, 0.0, 0.1, "a", "q"),
        (3, 1.0, 1.0, "b", "q"), (4, 0.9, 1.0, "b", "q"), (5, 1.0, 0.9, "b", "p")]
SCHEMA = "id int, x1 double, x2 double, c1 string, c2 string"
MODEL = K.KPrototypesModel(["x1", "x2"], ["c1", "c2"], [[0.0, 0.0], [1.0, 1.0]], [["a", "p"], ["b", "q"]], 0.5)


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_assign_labels_distances_and_cost(tiny):
    out = K.assign(tiny, MODEL, "label", "dist").orderBy("id").collect()
    assert [r.label for r in out] == [0, 0, 0, 1, 1, 1]
    assert [round(r.dist, 9) for r in out] == [0.0, 0.01, 0.51, 0.0, 0.01, 0.51]
    c = K.cost(tiny, MODEL).collect()[0]
    assert round(c.cost, 9) == 1.04 and c.n == 6


def test_tie_goes_to_lowest_label(spark):
    df = spark.createDataFrame([(9, 0.5, 0.5, "a", "q")], SCHEMA)
    r = K.assign(df, MODEL, "label", "dist").collect()[0]
    assert r.label == 0 and round(r.dist, 9) == 1.0


def test_update_means_and_modes(tiny):
    lab = K.assign(tiny, MODEL, "label")
    rows = {r.label: r for r in K.update(lab, ["x1", "x2"], ["c1", "c2"]).collect()}
    assert rows[0].size == 3 and rows[1].size == 3
    assert round(rows[0].x1, 9) == round(0.1 / 3, 9) and round(rows[1].x2, 9) == round(2.9 / 3, 9)
    assert (rows[0].c1, rows[0].c2, rows[1].c1, rows[1].c2) == ("a", "p", "b", "q")


def test_mode_tie_takes_smallest_value(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0, "b", "q"), (0, 0.0, 0.0, "a", "p")],
                               "label int, x1 double, x2 double, c1 string, c2 string")
    r = K.update(df, ["x1", "x2"], ["c1", "c2"]).collect()[0]
    assert (r.c1, r.c2) == ("a", "p")


def test_cao_density_and_init(tiny):
    dens = {r.id: r.density for r in K.cao_density(tiny, ["c1", "c2"]).collect()}
    assert all(abs(v - 0.5) < 1e-12 for v in dens.values())
    cats = K.cao_init(tiny, ["c1", "c2"], 2, ["id"])
    # all densities tie -> the first row; then the row most unlike it (ties -> smallest id)
    assert cats == [["a", "p"], ["b", "q"]]


def test_fit_separates_groups_and_cost_never_increases(spark, tiny):
    df = tiny.checkpoint()
    best, summary = K.fit(df, ["x1", "x2"], ["c1", "c2"], k=2, n_restarts=4, gamma=0.5, order_keys=["id"])
    for s in summary:
        h = [c for c in s["cost_history"] if c is not None]
        assert all(b <= a + 1e-9 for a, b in zip(h, h[1:]))
    labels = [r.label for r in K.assign(tiny, best, "label").orderBy("id").collect()]
    assert len(set(labels[:3])) == 1 and len(set(labels[3:])) == 1 and labels[0] != labels[3]
    assert best.cost == min(s["cost"] for s in summary)


def test_model_roundtrip(spark, tmp_path):
    from roadrisk.sources.files import load_model, save_model
    save_model(MODEL, spark, str(tmp_path / "m"))
    back = load_model(spark, str(tmp_path / "m"))
    assert back.centroids_num == MODEL.centroids_num and back.centroids_cat == MODEL.centroids_cat
    assert back.gamma == MODEL.gamma and back.num_cols == MODEL.num_cols
