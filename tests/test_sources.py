"""File sources on literal files: service pages (multi-line), GeoJSON grid, CSV reload."""
import json

from roadrisk.sources.files import read_corridor_grid, read_feature_json, read_features_csv, write_csv


def test_feature_pages_multiline(spark, tmp_path):
    page = {"features": [
        {"attributes": {"OBJECTID": 1, "FORMULARIO": "A000000001", "CIV": 5, "GRAVEDAD": "SOLO DANOS",
                        "FECHA_HORA_ACC": 1640995200000}, "geometry": {"x": -74.1, "y": 4.6}},
        {"attributes": {"OBJECTID": 2, "FORMULARIO": "A000000002", "CIV": None}, "geometry": None}]}
    (tmp_path / "p1.json").write_text(json.dumps(page, indent=2))
    rows = read_feature_json(spark, str(tmp_path), "siniestros", multiline=True).orderBy("OBJECTID").collect()
    assert [(r.OBJECTID, r.CIV, r.x) for r in rows] == [(1, 5, -74.1), (2, None, None)]
    veh = {"features": [{"attributes": {"OBJECTID": 7, "FORMULARIO": "A1", "CLASE": "BUS"}}]}
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "p.json").write_text(json.dumps(veh))
    r = read_feature_json(spark, str(tmp_path / "v"), "vehiculos", multiline=True).collect()[0]
    assert (r.OBJECTID, r.CLASE, r.SERVICIO) == (7, "BUS", None)


def test_grid_geojson(spark, tmp_path):
    fc = {"type": "FeatureCollection", "page": 0, "page_size": 4, "features": [
        {"type": "Feature", "properties": {"MVICIV": 10, "MVINOMBRE": None}},
        {"type": "Feature", "properties": {"MVICIV": 10, "MVINOMBRE": "AV X"}},
        {"type": "Feature", "properties": {"MVICIV": 11, "MVINOMBRE": "AV Y"}},
        {"type": "Feature", "properties": {"MVICIV": None, "MVINOMBRE": "AV Z"}}]}
    (tmp_path / "g.json").write_text(json.dumps(fc))
    rows = [tuple(r) for r in read_corridor_grid(spark, str(tmp_path)).orderBy("pos").collect()]
    assert rows == [(0, 10, None), (1, 10, "AV X"), (2, 11, "AV Y"), (3, None, "AV Z")]


def test_features_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("AV X", "Nocturno 2-5", 3, 1, 2, 1, 0, 2)],
                               "MVINOMBRE string, HORARIO string, accidentes long, muertes long, heridos long, "
                               "muertes_vulnerables long, heridos_vulnerables long, vulnerables int")
    write_csv(df, str(tmp_path / "f"))
    assert [tuple(r) for r in read_features_csv(spark, str(tmp_path / "f")).collect()] == [tuple(df.first())]
