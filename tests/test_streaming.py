from tesserae.streaming.releases import follow

VERSION = "k string, payload string, ver_id string, observed_from string, observed_to string, is_current boolean"


def test_releases_as_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    rows = [[("a", "1", "v1", "2026-01-01", None, True), ("b", "1", "v2", "2026-01-01", None, True)], [("a", "2", "w1", "2026-02-01", None, True)]]
    for release in rows:
        spark.createDataFrame(release, VERSION).coalesce(1).write.mode("append").parquet(str(source))
        query = follow(spark.readStream.schema(VERSION).parquet(str(source)), str(tmp_path / "out"), str(tmp_path / "check"), "k", "ver_id").trigger(availableNow=True).start()
        query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out" / "release-000000001.parquet")).collect()
    assert {(r.k, r.ver_id, r.observed_to, r.is_current) for r in out} == {("a", "v1", "2026-02-01", False), ("a", "w1", None, True), ("b", "v2", "2026-02-01", False)}
