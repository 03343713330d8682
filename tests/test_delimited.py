"""Delimited files: header groups, files that may be split, names and edges."""
import pytest
from pyspark.sql import types as T

from riskframe.sources import delimited

KINDS = T.StructType([T.StructField(c, T.DoubleType() if c != "id" else T.LongType()) for c in ("id", "latitude", "longitude")])


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_files_of_two_orders(spark, tmp_path):
    put(tmp_path / "f", "a.csv", "id,latitude,longitude\n1,10,20\n")
    put(tmp_path / "f", "b.csv", "id,longitude,latitude\n2,21,11\n")
    path = put(tmp_path / "f", "c.csv", "longitude,id\n22,3\n")
    got = sorted(map(tuple, delimited.read_csv(spark, path, KINDS).collect()))
    assert got == [(1, 10.0, 20.0), (2, 11.0, 21.0), (3, None, 22.0)]
    kinds = {f.name: f.dataType.simpleString() for f in delimited.infer_schema(spark, path)}
    assert kinds == {"id": "bigint", "latitude": "double", "longitude": "bigint"}
    files = [str(tmp_path / "f" / name) for name in ("a.csv", "b.csv")]
    assert delimited.read_csv(spark, files, KINDS).count() == 2


def test_line_breaks_decide_file_by_file(spark, tmp_path):
    put(tmp_path / "f", "plain.csv", "id,latitude,longitude\n" + "1,2,3\n" * 3)
    put(tmp_path / "f", "quoted.csv", 'id,latitude,longitude\n4,"5","6"\n')
    path = put(tmp_path / "f", "broken.csv", 'id,latitude,longitude\n7,"8\n",9\n')
    found = {tuple(p.rsplit("/", 1)[1] for p in g.paths): g.multi_line for g in delimited.survey_files(spark, path)}
    assert found == {("plain.csv", "quoted.csv"): False, ("broken.csv",): True}
    got = sorted(map(tuple, delimited.read_csv(spark, path, KINDS).collect()))
    assert got == [(1, 2.0, 3.0)] * 3 + [(4, 5.0, 6.0), (7, 8.0, 9.0)]
    assert {g.multi_line for g in delimited.survey_files(spark, path, multi_line=True)} == {True}


def test_a_large_file_is_many_tasks(spark, tmp_path):
    rows = "".join(f'{i},"{i % 90}",{i % 180}\n' for i in range(20_000))
    path = put(tmp_path / "f", "a.csv", "id,latitude,longitude\n" + rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        found = delimited.read_csv(spark, path, KINDS)
        assert found.rdd.getNumPartitions() >= 8
        assert sorted(map(tuple, found.collect())) == [(i, float(i % 90), float(i % 180)) for i in range(20_000)]
        template = delimited.read_template(spark, path, "id", "latitude")
        assert template.rdd.getNumPartitions() >= 8
        assert delimited.read_template(spark, path, "id", "latitude", multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_over_two_lines(spark, tmp_path):
    put(tmp_path / "f", "a.csv", '"the\nid",latitude\n1,2\n')
    path = put(tmp_path / "f", "b.csv", '"the\nname",latitude\nx,3\n')
    cells = delimited._cells(spark, path)
    assert sorted(cells.columns) == ["latitude", "the\nid", "the\nname"]
    assert sorted(map(str, cells.collect())) == sorted(
        ["Row(the\nid='1', latitude='2', the\nname=None)", "Row(the\nid=None, latitude='3', the\nname='x')"])


@pytest.mark.parametrize("name", ["a b.csv", "a%20b.csv", "é.csv", "a[1].csv", "a{b,c}.csv", "a+b#c.csv"])
def test_names_of_files(spark, tmp_path, name):
    put(tmp_path / "f", "first.csv", "id,latitude,longitude\n1,10,20\n")
    path = put(tmp_path / "f", name, "id,longitude,latitude\n2,21,11\n")
    assert sorted(map(tuple, delimited.read_csv(spark, path, KINDS).collect())) == [(1, 10.0, 20.0), (2, 11.0, 21.0)]


def test_empty_files_and_folders(spark, tmp_path):
    put(tmp_path / "f", "none.csv", "")
    path = put(tmp_path / "f", "only.csv", "id,latitude,longitude\n")
    assert delimited.read_csv(spark, path, KINDS).collect() == []
    bare = put(tmp_path / "g", "none.csv", "")
    with pytest.raises(ValueError, match="no column id"):
        delimited.read_csv(spark, bare, KINDS)
    assert len(delimited.infer_schema(spark, bare)) == 0
