from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import VectorUDT, Vectors
from pyspark.sql import functions as F

from tabloom.roles import JdbcRange, JdbcSource, table_schema
from tabloom.sinks.predictions import drop_vectors, write_predictions
from tabloom.sources.shared import fresh_path, shared_folder
from tabloom.sources.tables import conform, csv_header, first_lines, jdbc_options, local_rows, lower_case_columns, read_csv, read_jdbc, wrong_headers

SCHEMA = table_schema({"a": "double", "b": "string"})


def written(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text)
    return str(path)


def test_csv_scan(spark, tmp_path):
    path = written(tmp_path, "a,b\n1.5,x\n2,y\n")
    assert [tuple(r) for r in read_csv(spark, path, SCHEMA).collect()] == [(1.5, "x"), (2.0, "y")]
    assert read_csv(spark, path, SCHEMA, partitions=3).rdd.getNumPartitions() == 3
    assert csv_header(spark, path) == ["a", "b"]


def test_wrong_separator_is_an_error(spark, tmp_path):
    path = written(tmp_path, "a;b\n1.5;x\n")
    with pytest.raises(Exception):
        read_csv(spark, path, SCHEMA).collect()
    assert read_csv(spark, path, SCHEMA, separator=";").first() == (1.5, "x")
    # Without the check every value is null, which check_input reports.
    assert read_csv(spark, path, SCHEMA, check_header=False).where("b is not null").count() == 0


def test_other_header_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        read_csv(spark, written(tmp_path, "b,a\nx,1.5\n"), SCHEMA).collect()


@pytest.mark.parametrize("corrupt", [None, "broken"])
def test_every_file_of_a_folder_is_checked(spark, tmp_path, corrupt):
    for k in range(12):
        (tmp_path / f"part{k:02}.csv").write_text("a,b\n" + f"{k}.5,x\n" * 50)
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "quoted.csv").write_text('"A",b\n1.5,x\n')
    folder = str(tmp_path)
    assert read_csv(spark, folder, SCHEMA, corrupt_column=corrupt).where("a is not null").count() == 12 * 50 + 1
    assert first_lines(spark, folder).count() == 13
    (tmp_path / "part05.csv").write_text("b,a\n" + "x,1.5\n" * 50)
    with pytest.raises(ValueError, match="part05.csv: b,a"):
        read_csv(spark, folder, SCHEMA, corrupt_column=corrupt)
    assert [r["header"] for r in wrong_headers(spark, folder, ["a", "b"]).collect()] == ["b,a"]
    assert read_csv(spark, folder, SCHEMA, check_header=False, corrupt_column=corrupt).count() == 12 * 50 + 1


def test_bad_number(spark, tmp_path):
    path = written(tmp_path, "a,b\nabc,x\n2,y\n")
    assert read_csv(spark, path, SCHEMA).where("a is null").count() == 1
    kept = read_csv(spark, path, SCHEMA, corrupt_column="broken").cache()
    assert [r["broken"] for r in kept.collect()] == ["abc,x", None]
    with pytest.raises(Exception):
        read_csv(spark, path, SCHEMA, mode="FAILFAST").collect()


def test_lower_case(spark):
    df = spark.createDataFrame([(1, 2)], ["Ab", "cD"])
    assert lower_case_columns(df).columns == ["ab", "cd"]
    with pytest.raises(ValueError, match="ab"):
        lower_case_columns(spark.createDataFrame([(1, 2)], ["Ab", "aB"]))


def test_conform(spark):
    df = spark.createDataFrame([("x", 1, 9)], "b string, a int, extra int")
    got = conform(df, SCHEMA)
    assert got.dtypes == [("a", "double"), ("b", "string")] and got.first() == (1.0, "x")
    with pytest.raises(ValueError, match=r"missing columns \['b'\]"):
        conform(df.drop("b"), SCHEMA)
    with pytest.raises(ValueError, match="a: string to double"):
        conform(df.withColumn("a", F.lit("1")), SCHEMA)
    with pytest.raises(ValueError, match="double to int"):
        conform(spark.createDataFrame([(1.5,)], "a double"), table_schema({"a": "int"}))


def test_local_rows(spark):
    assert local_rows(spark, [(1.0, "x")], SCHEMA).schema == SCHEMA


class RecordingReader:
    """Stands in for the session's reader: keeps the options, returns a given table."""

    def __init__(self, table):
        self.table, self.seen = table, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.table


SOURCE = JdbcSource("jdbc:x:y", "S.T", "some.Driver", "user", "secret")


def test_jdbc_options():
    options = jdbc_options(SOURCE, JdbcRange("DURATION", 0, 5000, 6))
    assert options == {
        "driver": "some.Driver", "url": "jdbc:x:y", "dbtable": "S.T", "fetchsize": "1000", "user": "user", "password": "secret",
        "partitionColumn": "DURATION", "lowerBound": "0", "upperBound": "5000", "numPartitions": "6",
    }
    assert set(jdbc_options(JdbcSource("u", "t", "d"))) == {"driver", "url", "dbtable", "fetchsize"}
    assert "secret" not in repr(SOURCE)


def test_jdbc_scan_lowers_names_and_conforms(spark):
    reader = RecordingReader(spark.createDataFrame([(1, "x")], "A int, B string"))
    got = read_jdbc(SimpleNamespace(read=reader), SOURCE, JdbcRange("A", 0, 10, 2), SCHEMA)
    assert reader.seen["format"] == "jdbc" and reader.seen["numPartitions"] == "2"
    assert got.schema == SCHEMA and got.first() == (1.0, "x")


@pytest.fixture()
def predictions(spark):
    rows = [(i, 0.5, Vectors.dense(0.5, 0.5), 1.0) for i in range(20)]
    return spark.createDataFrame(rows, ["id", "p1", "probability", "idx_a"]).repartition(4)


def test_vectors_are_dropped_by_type(predictions):
    assert drop_vectors(predictions).columns == ["id", "p1", "idx_a"]
    assert drop_vectors(predictions, "idx_").columns == ["id", "p1"]
    assert any(isinstance(f.dataType, VectorUDT) for f in predictions.schema.fields)


def test_prediction_files(spark, predictions, tmp_path):
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    write_predictions(predictions, many)
    write_predictions(predictions, one, single_file=True)
    write_predictions(predictions, one, single_file=True)
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    for path in (many, one):
        back = read_csv(spark, path, table_schema({"id": "bigint", "p1": "double"}))
        assert sorted(r["id"] for r in back.collect()) == list(range(20))


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "t") != fresh_path(spark, "t")


def test_cluster_without_shared_folder_is_refused():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host", getCheckpointDir=lambda: None)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_another_header_by_position(spark, tmp_path):
    path = written(tmp_path, "emp.var.rate,contact\n1.5,x\n2.5,y\n")
    with pytest.raises(Exception):
        read_csv(spark, path, SCHEMA).collect()
    found = read_csv(spark, path, SCHEMA, check_header=False)
    assert found.columns == SCHEMA.names and [r[1] for r in found.collect()] == ["x", "y"]
