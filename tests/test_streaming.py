"""Streaming panel: files arriving per year are stacked once, year from the path."""
from surveyfold.streaming.panel import start_panel_stream


def test_panel_stream(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "state_2018.csv").write_text("state_fips,v\n01,1\n02,2\n")
    (src / "state_2015_2019.csv").write_text("state_fips,v\n01,9\n")
    out, ck = str(tmp_path / "panel"), str(tmp_path / "ck")
    q = start_panel_stream(spark, str(src), "state", "state_fips string, v int", out, ck)
    q.awaitTermination(120)
    (src / "state_2019.csv").write_text("state_fips,v\n01,3\n")
    q = start_panel_stream(spark, str(src), "state", "state_fips string, v int", out, ck)
    q.awaitTermination(120)
    rows = sorted((r.year, r.state_fips, r.v) for r in spark.read.parquet(out).collect())
    assert rows == [(2018, "01", 1), (2018, "02", 2), (2019, "01", 3)]
