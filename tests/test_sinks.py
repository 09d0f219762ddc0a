import glob
import tempfile
import zipfile

from encore.streaming import keyed_records, write_each_batch


def test_replayed_batch_replaces_itself(spark):
    base = tempfile.mkdtemp(prefix="encore-sink-")
    write = write_each_batch({"all": (lambda df: df, f"{base}/out")})
    batch = spark.range(3).withColumnRenamed("id", "x")
    write(batch, 0)
    write(batch, 1)
    write(batch, 1)                     # batch 1 replayed after a failure
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == 6
    assert sorted(r.batch for r in got.select("batch").distinct().collect()) == [0, 1]


def test_keyed_records(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, name string, v double")
    assert [tuple(r) for r in keyed_records(df, "id", "name").collect()] == [("1", "a")]
    (k, v), = [tuple(r) for r in keyed_records(df, "id", ["name", "v"]).collect()]
    assert k == "1" and v == '{"name":"a","v":2.5}'


def test_package_is_shipped_to_workers(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    zips = glob.glob(f"{folder}/pyfiles/encore-*.zip")
    assert zips
    names = zipfile.ZipFile(sorted(zips)[-1]).namelist()
    assert "encore/streaming/jobs.py" in names and "encore/plans/alerts.py" in names
