import os
import tempfile

import pytest

from lapse.sources import ingest as ing
from lapse.sources.sinks import read_model_split, write_model_table
from lapse.streaming.ingest import stream_convert

HEADER = "msno,is_churn\n"


def _csv(dirpath, name, body):
    os.makedirs(dirpath, exist_ok=True)
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write(HEADER + body)
    return p


def test_out_of_range_byte_fails(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/in", "a.csv", "u1,1\nu2,300\n")
    with pytest.raises(Exception):
        ing.convert(spark, "train", d + "/in", d + "/out")


def test_empty_integer_cell_fails(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/in", "a.csv", "u1,1\nu2,\n")
    with pytest.raises(Exception, match="is_churn"):
        ing.convert(spark, "train", d + "/in", d + "/out")


def test_convert_is_idempotent_and_typed(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/in", "a.csv", "u1,1\nu2,0\n")
    assert ing.convert(spark, "train", d + "/in", d + "/out") is True
    assert ing.convert(spark, "train", d + "/in", d + "/out") is False
    df = spark.read.parquet(d + "/out")
    assert dict(df.dtypes)["is_churn"] == "tinyint" and df.count() == 2


def test_half_written_output_is_done_again(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/in", "a.csv", "u1,1\nu2,0\n")
    os.makedirs(d + "/out/_temporary/0")
    assert ing.convert(spark, "train", d + "/in", d + "/out") is True
    assert spark.read.parquet(d + "/out").count() == 2


def test_pick_source_prefers_first_existing(spark):
    from conftest import SF001

    assert ing.pick_source(spark, SF001, ["user_logs", "events"]) == "events"


def test_stream_convert_each_file_once(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/in", "a.csv", "u1,1\nu2,0\n")
    stream_convert(spark, "train", d + "/in", d + "/out", d + "/ckpt")
    _csv(d + "/in", "b.csv", "u3,1\n")
    stream_convert(spark, "train", d + "/in", d + "/out", d + "/ckpt")
    out = spark.read.parquet(d + "/out")
    assert sorted(r.msno for r in out.collect()) == ["u1", "u2", "u3"]


def test_model_table_round_trip_prunes_split(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "user_key long, split string")
    write_model_table(df, d + "/mt")
    back = read_model_split(spark, d + "/mt", "val")
    assert [r.user_key for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()


def test_recommended_conf_scales_with_input():
    from lapse.session import recommended_conf

    small = recommended_conf(10 << 30)
    big = recommended_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_ingest_all_reports_rows_and_bytes(spark):
    d = tempfile.mkdtemp(prefix="lapse-t-", dir="/tmp")
    _csv(d + "/csv/train", "a.csv", "u1,1\nu2,0\n")
    _csv(d + "/csv/train_v2", "a.csv", "u1,0\n")
    inv = {r.table_name: r for r in ing.ingest_all(spark, d + "/csv", d + "/pq", ["train", "train_v2"]).collect()}
    assert inv["train"].n_rows == 2 and inv["train_v2"].n_rows == 1
    assert inv["train"].n_bytes > 0


def test_report_counts_the_load(spark, tmp_path):
    d = str(tmp_path)
    os.makedirs(d + "/in")
    with open(d + "/in/a.csv", "w") as f:
        f.write("msno,city,bd,gender,registered_via,registration_init_time\na,1,20,,3,20000101\nb,2,30,male,3,20000101\nc,2,31,,3,20000102\n")
    report, ran = ing.load(spark, "members", d + "/in", d + "/out")
    assert ran and report.n_rows == 3 and report.nulls == {
        "msno": 0, "city": 0, "bd": 0, "gender": 2, "registered_via": 0, "registration_init_time": 0}
    assert report.n_bytes == sum(os.path.getsize(os.path.join(d, "out", x)) for x in os.listdir(d + "/out") if x.startswith("part-"))
    again, ran = ing.load(spark, "members", d + "/in", d + "/out")
    assert not ran and again == report


def test_refused_load_tells_its_nulls_and_is_not_finished(spark, tmp_path):
    d = str(tmp_path)
    _csv(d + "/in", "a.csv", "u1,\nu2,\nu3,1\n")
    with pytest.raises(ValueError, match=r"of 3 rows: {'is_churn': 2}"):
        ing.load(spark, "train", d + "/in", d + "/out")
    assert not os.path.exists(d + "/out/_SUCCESS")
    _csv(d + "/in", "a.csv", "u1,0\n")
    assert ing.load(spark, "train", d + "/in", d + "/out")[0].n_rows == 1


def test_output_of_another_writer_is_counted(spark, tmp_path):
    spark.createDataFrame([("u1", 1), ("u2", 0)], "msno string, is_churn byte").write.parquet(str(tmp_path / "out"))
    report, ran = ing.load(spark, "train", "nowhere", str(tmp_path / "out"))
    assert not ran and report.n_rows == 2 and report.nulls == {"msno": 0, "is_churn": 0} and report.n_bytes > 0
