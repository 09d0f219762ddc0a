import tempfile

from encore.sources.files import parse_records, read_entity, write_keyed


def test_entity_files_and_keyed_records(spark, feed):
    for c, a in [(1, 2), (1, 3), (2, 3)]:
        feed.add("listen", customerid=c, artistid=a)
    l = feed.df(spark, "listen")
    base = tempfile.mkdtemp(prefix="encore-files-")
    l.write.mode("overwrite").json(f"{base}/listen")
    back = read_entity(spark, f"{base}/listen", "listen")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in l.collect())
    write_keyed(l, f"{base}/keyed", "id", ["id", "customerid", "artistid", "ts"])
    rec = spark.read.json(f"{base}/keyed")
    parsed = parse_records(rec, "listen")
    assert sorted(r.id for r in parsed.collect()) == sorted(r.id for r in l.collect())
    assert sorted(r.key for r in rec.collect()) == sorted(str(r.id) for r in l.collect())
