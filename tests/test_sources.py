import pytest
from pyspark.sql import functions as F

from colweave.schema import Roles, one_missing, prefix_schema
from colweave.sources import scan, sinks, synth

HEADER = ["line_id", "target", "number_0", "string_0", "id_0", "datetime_0", "onehot_a=1"]


def test_prefix_schema_types():
    types = [f.dataType.simpleString() for f in prefix_schema(HEADER).fields]
    assert types == ["bigint", "double", "double", "string", "string", "string", "int"]


def test_roles_override():
    roles = Roles({"price": "output", "number_0": "categorical", "string_0": "ignore"})
    assert roles.label == "price"
    assert roles.of("number_0") == "categorical"
    assert roles.features(["line_id", "price", "string_0", "number_1"]) == ["number_1"]
    with pytest.raises(ValueError):
        Roles({"a": "no such role"})
    with pytest.raises(ValueError):
        _ = Roles({"a": "output", "b": "output"}).label


def _csv(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_missing_spellings(spark, tmp_path):
    path = _csv(tmp_path, "line_id,target,number_0,string_0\n1,1,NaN,n/a\n2,0,,NULL\n3,1,2.5,x\n4,1,abc,\n")
    rows = scan.scan_csv(spark, path, bad="null").orderBy("line_id").collect()
    assert [(r["number_0"], r["string_0"]) for r in rows] == [(None, None), (None, None), (2.5, "x"), (None, None)]


@pytest.mark.parametrize(("limit", "rows"), [(None, 5), ("", 5), (-1, 5), ("-1", 5), (2, 2), ("3", 3), (0, 0), (9, 5)])
def test_csv_limit(spark, tmp_path, limit, rows):
    path = _csv(tmp_path, "line_id,number_0\n" + "".join(f"{5 - i},{i}\n" for i in range(5)))
    got = [r["line_id"] for r in scan.scan_csv(spark, path, limit).orderBy("line_id").collect()]
    assert got == [1, 2, 3, 4, 5][:rows]


def test_csv_columns_intersect(spark, tmp_path):
    path = _csv(tmp_path, "line_id,number_0,number_1\n1,2,3\n")
    assert scan.scan_csv(spark, path, columns=["number_1", "nothing"]).columns == ["number_1"]


def _lines(path, sizes):
    with open(path, "w") as out:
        out.write("line_id,string_0,number_0\n")
        for i, size in enumerate(sizes):
            out.write(f"{i},{'x' * size},{i % 10}\n")


def test_estimate_when_the_first_lines_are_ten_times_longer(spark, tmp_path):
    _lines(tmp_path / "a.csv", [1000] * 200 + [100] * 60_000)
    _lines(tmp_path / "b.csv", [100] * 5_000)
    got = scan.estimate(spark, str(tmp_path), ranges=64, width=4096).first()
    assert abs(got.rows - 65_200) < 6_520 and abs(got.rows - 65_200) < 4 * got.rows_error
    assert abs(got.total_size - (200 * 1000 + 65_000 * 100 + 65_200 * 16)) < 0.1 * got.total_size


def test_estimate_is_unbiased_over_seeds(spark, tmp_path):
    _lines(tmp_path / "a.csv", [400] * 500 + [10] * 20_000)
    found = [scan.estimate(spark, str(tmp_path), 8, 512, seed=s).first().rows for s in range(12)]
    assert abs(sum(found) / len(found) - 20_500) < 2_050 and len(set(found)) > 1


def test_estimate_of_small_compressed_and_empty_files(spark, tmp_path):
    _lines(tmp_path / "a.csv", [5] * 321)
    whole = scan.estimate(spark, str(tmp_path)).first()
    assert (whole.rows, whole.rows_error) == (321, 0.0)
    spark.read.text(str(tmp_path / "a.csv")).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "packed"))
    assert scan.estimate(spark, str(tmp_path / "packed")).first().rows == 321
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert tuple(scan.estimate(spark, str(tmp_path / "none")).first()) == (0, 0.0, 0, 0)


def test_estimate_is_close(spark, tmp_path):
    path = _csv(tmp_path, "line_id,number_0,string_0\n" + "".join(f"{10000 + i},1.5,abc\n" for i in range(1000)))
    got = scan.estimate(spark, path).first()
    assert abs(got["rows"] - 1000) < 30
    assert got["total_size"] == pytest.approx(got["rows"] * (8 + 8 + 3), rel=0.01)


def test_bounded_rows():
    assert scan.bounded_rows(5000, 10, fast=True) == 1000
    assert scan.bounded_rows(500, 10, fast=True) is None
    assert scan.bounded_rows(10**9, 42) == round(10**7 / 42, -1)
    assert scan.bounded_rows(10**5, 42) is None


def test_scan_bounded_cuts_only_what_the_caller_asks_for(spark, tmp_path):
    path = _csv(tmp_path, "line_id,number_0\n" + "".join(f"{i},1\n" for i in range(3000, 0, -1)))
    ends = F.count("line_id"), F.max("line_id")
    assert tuple(scan.scan_bounded(spark, path, 1000).agg(*ends).first()) == (1000, 1000)
    assert tuple(scan.scan_bounded(spark, path).agg(*ends).first()) == (3000, 3000)


def test_columns_go_by_the_header_of_each_file(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("line_id,number_0,number_1\n1,10,20\n")
    (tmp_path / "t" / "b.csv").write_text("number_1,line_id,string_0\n40,2,x\n")
    got = scan.scan_csv(spark, str(tmp_path / "t")).orderBy("line_id").collect()
    assert [tuple(r) for r in got] == [(1, 10.0, 20.0, None), (2, None, 40.0, "x")]


def test_quoted_line_breaks_and_bad_numbers(spark, tmp_path):
    path = _csv(tmp_path, 'line_id,string_0,number_0\n1,"a\nb ""c""",2\n2,x,N/A\n')
    got = [tuple(r) for r in scan.scan_csv(spark, path, multi_line=True).orderBy("line_id").collect()]
    assert got == [(1, 'a\nb "c"', 2.0), (2, "x", None)]
    with pytest.raises(Exception, match=".*"):
        scan.scan_csv(spark, path).collect()
    (tmp_path / "bad").mkdir()
    path = _csv(tmp_path / "bad", "line_id,number_0,number_1\n1,bad,1\n2,3,\n")
    with pytest.raises(Exception, match="not a double in number_0: bad"):
        scan.scan_csv(spark, path).collect()
    assert [r.number_0 for r in scan.scan_csv(spark, path, bad="null").orderBy("line_id").collect()] == [None, 3.0]
    assert {r["column"]: r["bad"] for r in scan.bad_cells(spark, path).collect()} == {"line_id": 0, "number_0": 1, "number_1": 0}


def test_prediction_sink_replaces(spark, tmp_path):
    path = str(tmp_path / "p")
    for n in (5, 3):
        sinks.save_predictions(spark.range(n).selectExpr("id line_id", "id * 0.5D prediction", "1 extra"), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["line_id", "prediction"] and back.count() == 3


def test_metrics_by_schema_and_union(spark, tmp_path):
    root = str(tmp_path / "m")
    assert sinks.load_metrics(spark, root, "train") is None
    three = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    four = spark.createDataFrame([(5, 6.0, "y", 7)], "a int, b double, c string, d int")
    first = sinks.save_metrics(three, root, "train", "r1")
    assert sinks.save_metrics(three, root, "train", "r2") == first
    assert sinks.save_metrics(four, root, "train", "r3") != first
    assert first == sinks.schema_hash(["a", "b", "c", "run_id"])
    back = sinks.load_metrics(spark, root, "train").orderBy("run_id").select("run_id", "d").collect()
    assert [tuple(r) for r in back] == [("r1", None), ("r2", None), ("r3", 7)]


def test_append_metrics_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "m")
    for i in range(3):
        sinks.append_metrics(spark.createDataFrame([(i,)], "a int"), path)
    assert sorted(r["a"] for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1", "2"]


def test_noise_table_depends_on_key_only(spark):
    one = synth.noise_table(spark.range(200).withColumnRenamed("id", "line_id"), 4)
    two = synth.noise_table(spark.range(200).repartition(7).withColumnRenamed("id", "line_id"), 4)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    mean = one.agg(F.avg("number_0"), F.max("number_0")).first()
    assert 0.4 < mean[0] < 0.6 and mean[1] < 1


def test_one_missing_turns_nan_to_null(spark):
    df = spark.sql("select cast('NaN' as double) a, 'nan' b, 1.0D c")
    assert tuple(one_missing(df).first()) == (None, None, 1.0)


def test_inject_missing_is_half_open(spark):
    df = spark.range(6).selectExpr("id line_id", "id * 1.0D number_0")
    got = synth.inject_missing(df, {"number_0": (2, 4)}).orderBy("line_id").collect()
    assert [r["number_0"] for r in got] == [0.0, 1.0, None, None, 4.0, 5.0]
