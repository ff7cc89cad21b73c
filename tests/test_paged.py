"""The source of landed pages in batches and in a stream."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cadenza.sources import flatten, landed, paged
from cadenza.streaming import logs


def land(path, number, minutes):
    times = [datetime(2024, 1, 1) + timedelta(minutes=m) for m in minutes]
    items = [{"added_at": t.isoformat() + "Z", "track": {"id": f"t{m}", "name": f"é{m}", "artists": [{"id": "a", "name": "A"}]}} for t, m in zip(times, minutes, strict=True)]
    name = path / paged.page_name(number, times)
    name.write_text(json.dumps({"items": items}))
    return name


@pytest.fixture
def pages(spark, tmp_path):
    paged.register(spark)
    path = tmp_path / "pages"
    path.mkdir()
    for number in range(10):  # newest first: page 0 holds minutes 90 to 99
        land(path, number, range(99 - 10 * number, 89 - 10 * number, -1))
    (path / "other.txt").write_text("no page")
    return path


def test_pages_before_a_cursor_stay_closed(spark, pages):
    read = lambda **o: spark.read.format("landed_pages").options(path=str(pages), pages="3", **o).load()
    every = read()
    assert every.count() == 100 and every.rdd.getNumPartitions() == 4
    tracks = flatten.saved_tracks(every.select(F.from_json("item", landed.SCHEMAS["saved_tracks"]).alias("i")).select("i.*"))
    assert {(r.spotify_track_id, r.track_name, r.artist_name) for r in tracks.collect()} == {(f"t{m}", f"é{m}", "A") for m in range(100)}
    for name in pages.iterdir():  # what may not be opened can't be read
        if int(name.name.split("-")[1] if name.name.startswith("page") else 0) >= 4:
            name.write_text("{broken")
    assert {r.page for r in read(since="2024-01-01T01:04:00Z").collect()} == {0, 1, 2, 3}
    assert read(since="2024-01-01T01:04:00Z").count() == 35 and read(since="2030-01-01").count() == 0
    with pytest.raises(Exception, match="not a time"):
        read(since="soon").count()


def test_a_filter_skips_pages(spark, pages):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for name in pages.glob("page-*"):
            if int(name.name.split("-")[1]) >= 2:
                name.unlink()
                (pages / name.name).mkdir()  # opening it would fail
        got = spark.read.format("landed_pages").options(path=str(pages), pushdown="true").load()
        assert got.where("added_at >= timestamp '2024-01-01 01:20:00' and page >= 1").count() == 10
        assert got.where("added_at > timestamp '2024-01-01 01:20:00'").count() == 19
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_stream_goes_on_from_its_cursor(spark, pages, tmp_path):
    found = []

    def run():
        batches = []
        stream = spark.readStream.format("landed_pages").option("path", str(pages)).option("since", "2024-01-01T01:29:00Z").load()
        logs.start(stream, lambda df, n: batches.extend(sorted(F_row.added_at.minute for F_row in df.collect())), str(tmp_path / "checkpoint")).start().awaitTermination(120)
        found.append(batches)

    run()
    for name in pages.glob("page-*"):  # the next pages of the list; older ones are closed for good
        if int(name.name.split("-")[1]) >= 1:
            name.write_text("{broken")
    land(pages, 10, range(104, 94, -1))
    run()
    run()
    assert found == [list(range(30, 40)), list(range(40, 45)), []]
