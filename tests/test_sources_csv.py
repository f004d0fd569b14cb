"""CSV and road files as they come: separators, column order, mixed forms, missing properties."""

import pytest
from pyspark.sql import types as T

from georisk import session
from georisk.operators import spatial, tables
from georisk.plans import jobs
from georisk.sources import files
from georisk.operators.versions import Store
from georisk.sources.grid import load_enriched_grid


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_forms_of_time_and_department_stay_text(spark, tmp_path):
    put(tmp_path, "c-2020.csv", "Num_Acc,jour,mois,an,hrmn,lat,long,atm,dep\n1,5,1,2020,14:30,\"-22,1\",\"166,4\",1,988\n")
    put(tmp_path, "c-2021.csv", "Num_Acc;an;mois;jour;dep;hrmn;lat;long;atm\n2;2021;1;5;988;1430;-22,1;166,4;2\n"
                                "3;2021;1;5;2A;915;-22,1;166,4;x\n4;2021;1;6;988;915;-22,1;166,4;x\n")
    out, counts = jobs.bronze(spark, str(tmp_path / "c-*.csv"), out_dir=str(tmp_path / "bronze"))
    rows = sorted((r.num_acc, str(r.datetime), r.atm) for r in out.collect())
    assert rows == [(1, "2020-01-05 14:30:00", 1), (2, "2021-01-05 14:30:00", 2), (4, "2021-01-06 09:15:00", None)]
    assert counts == {"caracteristiques": 4, "accidents_nc": 3}
    store = Store(spark, str(tmp_path / "bronze"))
    assert store.read("accidents_nc").count() == 3 and store.meta()["counts"] == counts
    schema = T.StructType([T.StructField("dep", T.StringType()), T.StructField("Num_Acc", T.LongType()), T.StructField("new", T.DateType())])
    got = files.scan_csv_union(spark, [str(tmp_path / "c-2020.csv"), str(tmp_path / "c-2021.csv")], schema=schema)
    assert sorted(tuple(r) for r in got.collect()) == [("2A", 3, None), ("988", 1, None), ("988", 2, None), ("988", 4, None)]


def test_road_file_without_ids_classes_and_with_multilines(spark, tmp_path):
    line = '{"type":"Feature","properties":{%s},"geometry":{"type":"%s","coordinates":%s}}\n'
    put(tmp_path, "roads.json", line % ("", "LineString", "[[166.0,-22.0],[166.1,-22.0]]")
        + line % ("", "MultiLineString", "[[[166.2,-22.0],[166.3,-22.0]],[[166.4,-22.0],[166.4,-22.1],[166.5,-22.1]]]")
        + line % ("", "Point", "[166.0,-22.0]"))
    seg = files.read_road_edges(spark, str(tmp_path / "roads.json"))
    assert seg.count() == 4 and seg.select("edge_id").distinct().count() == 2
    assert {(r.road_type, r.speed_limit) for r in spatial.road_attributes(seg).collect()} == {(2, 50)}
    put(tmp_path, "named.json", line % ('"highway":["tertiary","x"],"maxspeed":70', "LineString", "[[166.0,-22.0],[166.1,-22.0]]"))
    named = files.read_road_edges(spark, str(tmp_path / "named.json"))
    assert [(r.road_type, r.speed_limit) for r in spatial.road_attributes(named).collect()] == [(2, 70)]


def test_enriched_grid_is_built_once_and_not_over_an_unreadable_store(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(-22.0, 166.0, 3, 7.5)], "latitude double, longitude double, "
                                     "accident_density_5km long, dist_to_noumea_km double")
    path = str(tmp_path / "grid")
    for _ in range(2):
        assert load_enriched_grid(spark, path, build).count() == 1
    assert built == [1] and Store(spark, path).meta()["n_points"] == 1
    for part in (tmp_path / "grid" / "grid").glob("*/part-*.parquet"):
        put(part.parent, part.name, "no parquet")
    with pytest.raises(Exception):
        load_enriched_grid(spark, path, build).count()
    assert built == [1] and len(Store(spark, path).versions()) == 1


def test_empty_run_empties_its_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "date string, x int")
    tables.replace_partition(df, path)
    tables.replace_partition(df.limit(0), path, values=["2026-01-02"])
    left = tables.read_table(spark, path)
    assert [(r.date, r.x) for r in left.collect()] == [("2026-01-01", 1)]


def test_layout_replaces_all_dates(spark, tmp_path):
    path = str(tmp_path / "l")
    for day in ("2026-01-01", "2026-01-02"):
        tables.layout_for_lookup(spark.createDataFrame([(day, 1, 0.5)], "date string, hour int, probability double"), path)
    assert [str(r.date) for r in spark.read.parquet(path).collect()] == ["2026-01-02"]


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

        def set(self, key, value):
            raise AssertionError("nothing may be set")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Spark())
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]")


def test_scratch_tables_are_released(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", [])
    df = session.cut_lineage(spark.range(3), "t_release")
    path = session._written[0]
    assert df.count() == 3 and tables.path_exists(spark, path)
    assert session.release_scratch(spark) == 1 and not tables.path_exists(spark, path)


def test_lenient_scan_goes_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("Num_Acc", T.LongType()), T.StructField("jour", T.IntegerType()),
                           T.StructField("dep", T.StringType()), T.StructField("atm", T.IntegerType())])
    put(tmp_path, "a.csv", "Num_Acc,jour,dep,atm\n1,5,988,2\n2,oops,988,2\n")
    put(tmp_path, "b.csv", "dep,jour,Num_Acc,more\n2A,3,3,x\n988,4,4,y\n988,4\n")
    put(tmp_path, "c.csv", "\ufeffatm;dep;jour;Num_Acc\n;988;7;5\nx;988;8;6\n")
    put(tmp_path, "empty.csv", "")
    got = files.scan_csv_lenient(spark, [str(tmp_path)], schema)
    assert sorted(((r.Num_Acc, r.jour, r.dep, r.atm) for r in got.collect()), key=str) == [
        (1, 5, "988", 2), (3, 3, "2A", None), (4, 4, "988", None), (5, 7, "988", None)]
    assert {r.filename.rsplit("/", 1)[1] for r in got.collect()} == {"a.csv", "b.csv", "c.csv"}
    assert files.scan_csv_lenient(spark, [str(tmp_path / "empty.csv")], schema).count() == 0


FEATURE = '{ "type": "Feature", "properties": {"edge_id": %d, "highway": "primary", "maxspeed": %s}, "geometry": ' \
          '{ "type": "LineString", "coordinates": [[166.%d, -22.0], [167.0, -22.5], [167.1, -22.5]] } }'


def test_one_document_is_parsed_by_many_tasks(spark, tmp_path):
    speeds = ["80.0", "70", '"80.0"', '"60 km/h"', "[90.5]", '["30", "50"]', "null", "[]"]
    head = '{\n"type": "FeatureCollection",\n"crs": {"type": "name"},\n"features": [\n'
    put(tmp_path, "roads.geojson", head + ",\n".join(FEATURE % (i, speeds[i % 8], i) for i in range(4000)) + "\n]\n}\n")
    path = str(tmp_path / "roads.geojson")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = files.read_feature_collection(spark, path)
        assert found.rdd.getNumPartitions() > 5
        assert found.count() == 4000 and found.filter("geometry.type = 'LineString' AND type = 'Feature'").count() == 4000
        seg = files.read_road_edges(spark, path, multiline=True)
        doc = T.StructType([T.StructField("features", T.ArrayType(files.ROAD_FEATURE_SCHEMA))])
        one = spark.read.option("multiLine", True).schema(doc).json(path).selectExpr("explode(features) AS f").select("f.*")
        bare = lambda df: df.selectExpr("type", "geometry.type AS kind", "from_json(geometry.coordinates, 'array<array<double>>') AS at",
                                        "replace(properties, ' ') AS properties")
        assert one.rdd.getNumPartitions() == 1 and bare(one).exceptAll(bare(found)).count() == 0
        assert seg.count() == 8000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    attrs = {r.edge_id: r.speed_limit for r in spatial.road_attributes(seg).collect()}
    assert [attrs[i] for i in range(8)] == [80, 70, 50, 60, 90, 30, 50, 50]


def test_documents_of_another_shape_are_parsed_whole(spark, tmp_path):
    other = '{"geometry": {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}, "type": "Feature", "properties": {"edge_id": %d}}'
    put(tmp_path, "a.geojson", '{"features": [' + other % 1 + "," + other % 2 + '], "type": "FeatureCollection"}')
    mixed = FEATURE % (3, "50", 1) + "," + other % 4
    put(tmp_path, "b.geojson", '{"type": "FeatureCollection", "features": [' + mixed + "]}")
    put(tmp_path, "c.geojson", '{"type": "FeatureCollection", "features": [' + FEATURE % (5, "50", 1) + "]}")
    put(tmp_path, "d.geojson", '{"type": "FeatureCollection", "features": []}')
    seg = files.read_road_edges(spark, str(tmp_path), multiline=True)
    assert sorted((r.edge_id, r.seg) for r in seg.collect()) == [(1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (5, 0), (5, 1)]


def test_a_polyline_is_one_edge_again(spark, tmp_path):
    rows = [(1, 0, 0, 1.0, 2.0, 3.0, 4.0), (1, 0, 1, 3.0, 4.0, 5.0, 6.0), (2, 0, 0, 1.0, 2.0, 3.0, 4.0),
            (3, 0, 0, 1.0, 2.0, 3.0, 4.0), (3, 0, 1, 3.0, 4.0, 5.0, 6.0),                 # the geometry of edge 1
            (4, 0, 0, 1.0, 2.0, 3.0, 4.0), (4, 1, 0, 7.0, 8.0, 9.0, 9.5)]
    roads = spark.createDataFrame(rows, "edge_id long, part int, seg int, lon1 double, lat1 double, lon2 double, lat2 double") \
        .selectExpr("*", "'primary' AS highway", "'50' AS maxspeed")
    files.write_road_edges(roads, str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).count() == 3
    back = files.read_road_edges(spark, str(tmp_path / "r"))
    assert sorted((r.edge_id, r.part, r.seg, r.lon1, r.lat1, r.lon2, r.lat2) for r in back.collect()) == [r for r in rows if r[0] != 3]
