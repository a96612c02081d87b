"""Sources, merges, the stream and the feed."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from roundscope import session
from roundscope.schemas import UNIQUE_KEYS, WAREHOUSE
from roundscope.sources import bundles, damage, feed, warehouse
from roundscope.streaming.ingest import ingest_stream

SHOT = "demo_file string, round int, tick int, event_id string, weapon string, extra string"


def _write_match(spark, root, match, shots, rounds=()):
    spark.createDataFrame(shots, SHOT).coalesce(1).write.parquet(f"{root}/{match}/events_shots")
    if rounds:
        spark.createDataFrame(rounds, "demo_file string, round int, winner string").coalesce(1).write.parquet(f"{root}/{match}/rounds")


@pytest.fixture
def matches(spark, tmp_path):
    root = str(tmp_path / "matches")
    _write_match(spark, root, "m1", [("d", 1, 5, "e1", "ak", "x"), ("d", 1, 6, None, "ak", "x"), ("d", 1, 6, None, "ak", "x")], [("d", 1, "ct")])
    # The same file name in another match gives the same event id.
    _write_match(spark, root, "m2", [("d", 1, 5, "e1", "awp", "x"), ("d", 1, 9, "e2", "awp", "x")])
    return root


def test_build_keeps_the_first_writer(spark, matches, tmp_path, rows):
    root = str(tmp_path / "warehouse")
    assert warehouse.build(spark, matches, root) == ["rounds", "events_shots"]
    shots = warehouse.read_table(spark, root, "events_shots")
    assert shots.schema == WAREHOUSE["events_shots"]
    expected = [("m1", None, "ak"), ("m1", None, "ak"), ("m1", "e1", "ak"), ("m2", "e2", "awp")]
    assert rows(shots, "match_id", "event_id", "weapon") == expected
    assert warehouse.read_table(spark, root, "rounds").count() == 1
    assert warehouse.read_table(spark, root, "header").count() == 0
    # A second run adds nothing with a key, and repeats rows of tables without one.
    warehouse.build(spark, matches, root)
    again = warehouse.read_table(spark, root, "events_shots").filter("event_id is not null")
    assert rows(again, "match_id", "event_id") == [("m1", "e1"), ("m2", "e2")]
    assert warehouse.read_table(spark, root, "rounds").count() == 2


def test_views(spark, matches, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse.build(spark, matches, root)
    warehouse.register_views(spark, root, "wh_")
    assert warehouse.one(spark, "SELECT count(DISTINCT match_id) FROM wh_events_shots") == 2
    assert warehouse.one(spark, "SELECT count(*) FROM wh_events_shots WHERE weapon = :w", w="awp") == 1
    assert warehouse.one(spark, "SELECT count(*) FROM no_such_table") == 0
    assert spark.table("wh_header").count() == 0


def test_named_batch_replaces_itself(spark, matches, tmp_path):
    root = str(tmp_path / "warehouse")
    for _ in range(2):
        warehouse.build(spark, matches, root, batch="one")
    assert warehouse.read_table(spark, root, "rounds").count() == 1


@pytest.mark.parametrize("match", ["007", "1e3", "1.10", "2024-01-02", "plain"])
def test_match_ids_keep_their_text(spark, tmp_path, rows, match):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    loadout = "demo_file string, round int, steamid string"
    spark.createDataFrame([("d", 1, "s1"), ("d", 2, "s1")], loadout).write.parquet(f"{source}/{match}/round_loadouts")
    for _ in range(2):
        warehouse.build(spark, source, root)
    assert rows(warehouse.read_table(spark, root, "round_loadouts"), "match_id", "round") == [(match, 1), (match, 2)]


def test_small_matches_share_files(spark, tmp_path):
    root = str(tmp_path / "wh")
    frame = spark.range(10_000).select(F.concat(F.lit("m"), F.col("id") % 1000).alias("match_id"), F.lit("d").alias("demo_file"), F.col("id").cast("int").alias("round"))
    warehouse.merge_into(spark, root, "rounds", frame)
    stored = warehouse.read_table(spark, root, "rounds")
    assert stored.select("match_id").distinct().count() == 1000 and stored.count() == 10_000
    assert len(stored.inputFiles()) <= 8


def test_sources_with_clashing_columns(spark, tmp_path, rows):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for match, kind, value in (("a", "int", 1), ("b", "string", "2"), ("c", "boolean", True)):
        row = spark.createDataFrame([("d", 1, value, "7" if match == "b" else 7)], f"demo_file string, round int, planted {kind}, start {'string' if match == 'b' else 'bigint'}")
        row.coalesce(1).write.parquet(f"{source}/{match}/rounds")
    assert warehouse.build(spark, source, root) == ["rounds"]
    assert rows(warehouse.read_table(spark, root, "rounds"), "match_id", "start") == [("a", 7), ("b", 7), ("c", 7)]
    assert warehouse.read_rejected(spark, root).count() == 0


def test_broken_files_are_noted(spark, matches, tmp_path, rows):
    root = str(tmp_path / "wh")
    (tmp_path / "matches" / "m9" / "events_shots").mkdir(parents=True)
    (tmp_path / "matches" / "m9" / "events_shots" / "x.parquet").write_text("broken")
    for _ in range(2):
        warehouse.build(spark, matches, root)
    shots = warehouse.read_table(spark, root, "events_shots").filter("event_id is not null")
    assert rows(shots, "match_id", "event_id") == [("m1", "e1"), ("m2", "e2")]
    lost = warehouse.read_rejected(spark, root).collect()
    assert [(r.table, r.path.rsplit("/", 1)[1]) for r in lost] == [("events_shots", "x.parquet")] and lost[0].reason
    with pytest.raises(Exception):
        warehouse.read_sources(spark, f"{matches}/*/events_shots", WAREHOUSE["events_shots"])


def test_broken_files_of_a_stream_are_noted(spark, tmp_path, rows):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([("d", i, i, f"e{i}", "ak", "x")], SHOT).coalesce(1).write.parquet(f"{source}/{i}")
    (tmp_path / "in" / "bad.parquet").write_text("broken")
    schema = spark.createDataFrame([], SHOT).schema
    for _ in range(2):
        ingest_stream(spark, source, root, "events_shots", schema).awaitTermination()
        assert rows(warehouse.read_table(spark, root, "events_shots"), "event_id") == [("e0",), ("e1",), ("e2",)]
        assert [r.path.rsplit("/", 1)[1] for r in warehouse.read_rejected(spark, root).collect()] == ["bad.parquet"]


def test_merge_ignore(spark, rows):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), (None, 0)], schema)
    source = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3), (None, 5), (None, 5)], schema)
    once = warehouse.merge_ignore(target, source, ["k"])
    assert rows(once) == [(None, 0), (None, 5), (None, 5), ("a", 1), ("b", 3)]
    added = rows(warehouse.new_rows(target, source, ["k"]))
    assert added == rows(warehouse.new_rows(target, source, ["k"], source_rows=5)) == [(None, 5), (None, 5), ("b", 3)]
    keyed = source.filter("k is not null")
    assert rows(warehouse.merge_ignore(once, keyed, ["k"])) == rows(once)
    assert rows(warehouse.merge_append(target, source.drop("v")))[0] == (None, None)


def test_stream_equals_batch(spark, tmp_path, rows):
    source, root, place = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], SHOT).schema
    for name, shots in (("one", [("d", 1, 1, "e1", "ak", "x")]), ("two", [("d", 1, 1, "e1", "ak", "x"), ("d", 2, 2, "e2", "ak", "x")])):
        spark.createDataFrame(shots, SHOT).coalesce(1).write.parquet(f"{source}/{name}")
    for _ in range(2):
        ingest_stream(spark, source, root, "events_shots", schema, place).awaitTermination()
        assert rows(warehouse.read_table(spark, root, "events_shots"), "event_id") == [("e1",), ("e2",)]
    spark.createDataFrame([("d", 3, 3, "e3", "ak", "x"), ("d", 1, 1, "e1", "ak", "x")], SHOT).write.parquet(f"{source}/three")
    ingest_stream(spark, source, root, "events_shots", schema, place, files_per_batch=1).awaitTermination()
    assert rows(warehouse.read_table(spark, root, "events_shots"), "event_id") == [("e1",), ("e2",), ("e3",)]
    with pytest.raises(ValueError):
        ingest_stream(spark, source, root, "nothing", schema)


def test_stream_of_a_table_without_a_key(spark, tmp_path, rows):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    frame = spark.createDataFrame([("m", "d", 1, "ct"), ("m", "d", 1, "ct")], "match_id string, demo_file string, round int, winner string")
    frame.write.parquet(source)
    for attempt in ("a", "b"):  # a lost progress folder repeats the batch
        ingest_stream(spark, source, root, "rounds", frame.schema, str(tmp_path / attempt)).awaitTermination()
    assert warehouse.read_table(spark, root, "rounds").count() == 2


def test_repeated_batch_with_missing_keys(spark, tmp_path, rows):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("d", 1, 1, "e1", "ak", "x"), ("d", 1, 2, None, "ak", "x"), ("d", 1, 2, None, "ak", "x")], SHOT).write.parquet(source)
    schema = spark.read.parquet(source).schema
    for attempt in ("a", "b"):
        ingest_stream(spark, source, root, "events_shots", schema, str(tmp_path / attempt)).awaitTermination()
        assert rows(warehouse.read_table(spark, root, "events_shots"), "event_id") == [(None,), (None,), ("e1",)]


def test_conform_and_read_sources(spark, tmp_path, rows):
    path = str(tmp_path / "https___a.b_1.parquet")
    spark.createDataFrame([("d", "7", "x")], "demo_file string, other string, map_name string").coalesce(1).write.parquet(path)
    out = warehouse.read_sources(spark, path, WAREHOUSE["header"], warehouse.stem(F.lit("/x/https___a.b_1.sqlite")))
    assert rows(out) == [("https___a.b_1", "d", "x", None, None)]
    bad = spark.createDataFrame([("x", "n/a")], "demo_file string, tickrate string")
    assert warehouse.conform(bad, WAREHOUSE["header"]).first().tickrate is None


def test_missing_tables(spark, tmp_path):
    assert bundles.read_bundle(spark, str(tmp_path), "none").columns == []
    assert bundles.read_bundle(spark, str(tmp_path), "none", "a int").columns == ["a"]
    os.makedirs(tmp_path / "empty")
    assert bundles.read_bundle(spark, str(tmp_path), "empty").columns == []
    (tmp_path / "rows").mkdir()
    (tmp_path / "rows" / "a.json").write_text('{"a": 1, "b": 2}\nnot json\n')
    assert [r.a for r in bundles.read_bundle(spark, str(tmp_path), "rows", "a int, b int", "json", ["a"]).collect()] == [1, None]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("broken")
    with pytest.raises(Exception):
        bundles.read_bundle(spark, str(tmp_path), "bad").collect()


def test_headers(spark):
    cases = [
        ("a", {"tickrate": "", "tickRate": "64", "map_name": "de"}, 64.0, "de"), ("b", {"tickrate": "0", "mapName": "x"}, 128.0, "x"),
        ("c", {"ticksPerSecond": "bad"}, 128.0, None), ("d", None, 128.0, None), ("e", {"tickrate": "32", "tickRate": "64", "map_name": "", "mapName": "y"}, 32.0, "y"),
    ]
    df = spark.createDataFrame([(n, h) for n, h, *_ in cases], "demo_file string, header map<string,string>")
    found = {r.demo_file: (r.tickrate, r.map_name) for r in bundles.header_rows(df).collect()}
    assert found == {n: (t, m) for n, _, t, m in cases}


def test_default_tickrate(spark):
    df = spark.createDataFrame([("a", "64.9"), ("b", "32")], "m string, tickrate string")
    value = lambda d: spark.range(1).select(bundles.default_tickrate(d, order=["m"]).alias("r")).first().r
    assert value(df) == 64.0
    assert value(df.filter("m = 'c'")) == 64.0
    assert value(df.withColumn("tickrate", F.lit("bad"))) == 64.0
    assert value(df.filter("m = 'b'")) == 32.0
    assert value(df.withColumnRenamed("tickrate", "tick_rate_hz")) == 64.0
    assert value(df.filter("m = 'b'").withColumnRenamed("tickrate", "tick_rate")) == 32.0
    assert value(df.drop("tickrate")) == 64.0


def test_catalog_and_entities(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "x int, y string")
    tables = {"rounds": df, "header": df.limit(1), "kills_slim": None, "events_bomb": df}
    out = warehouse.catalog(tables).collect()
    assert [(r.table, r["rows"]) for r in out] == [("events_bomb", 3), ("rounds", 3), ("header", 1), ("kills_slim", None)]
    assert rows(warehouse.entities({"xs": (df, "x"), "ys": (df, "y"), "all": (df, None), "no": (None, "z")})) == [("all", 3), ("no", 0), ("xs", 2), ("ys", 2)]
    assert set(UNIQUE_KEYS) < set(WAREHOUSE)


def test_feed(spark, tmp_path, rows):
    (tmp_path / "urls.txt").write_text("https://a.b/c?d\n\n \nhttps://a.b/e\n")
    manifest = rows(feed.url_manifest(spark, str(tmp_path / "urls.txt")), "url", "slug")
    assert manifest == [(" ", "_"), ("https://a.b/c?d", "https___a.b_c_d"), ("https://a.b/e", "https___a.b_e")]

    blobs = [
        ("zip", b"PK\x03\x04" + b"\x00" * 100), ("rar", b"Rar!\x1a\x07" + b"\xff" * 100), ("7z", bytes.fromhex("377ABCAF271C") + b"\x01" * 100),
        ("bz", b"BZh9" + b"\x80" * 100), ("raw", b"PBDEMS2\x00" + b"\x02" * 100), ("page", b" \n<!DOCTYPE html>" + "é".encode() * 100),
        ("text", b"plain words\n" * 20), ("short", b"\x00\x01"), ("empty", b""), ("none", None),
    ]
    df = spark.createDataFrame(blobs, "name string, content binary")
    found = {r.name: (r.kind, r.accepted) for r in feed.triage(df, min_bytes=100).collect()}
    assert found == {
        "zip": ("zip", True), "rar": ("rar", True), "7z": ("7z", True), "bz": ("bzip2", True), "raw": ("raw", True),
        "page": ("raw", False), "text": ("raw", False), "short": ("raw", False), "empty": ("raw", False), "none": ("raw", False),
    }
    top = spark.createDataFrame([("u/1", "x y"), ("u/1", "x y"), ("u/1", None), ("u/2", "a"), ("u/2", "b"), ("u/3", None)], "url string, top_dir string")
    assert rows(feed.match_slug(top)) == [("u/1", "x_y"), ("u/2", "u_2"), ("u/3", "u_3")]

    for name in ("a.DEM", "sub/b.dem", "sub/c.txt"):
        (tmp_path / "files" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "files" / name).write_bytes(b"xy")
    assert sorted(r.path.rsplit("/", 1)[1] for r in feed.find_files(spark, str(tmp_path / "files")).collect()) == ["a.DEM", "b.dem"]


def test_stored_tables_use_the_shared_folder(spark, tmp_path):
    df = session.stored(spark.range(10).selectExpr("id % 3 AS k", "id AS v"), ["k"])
    assert df.columns == ["k", "v"] or set(df.columns) == {"k", "v"}
    assert df.filter("k = 1").count() == 3
    folder = session.shared_folder(spark).removeprefix("file:").rstrip("/")
    assert df.inputFiles() and all(folder in f for f in df.inputFiles())


def _damage(path):
    """Overwrite the pages of a file; its footer stays."""
    data = bytearray(path.read_bytes())
    size = int.from_bytes(data[-8:-4], "little")
    data[4 : len(data) - 8 - size] = b"\xa5" * (len(data) - 12 - size)
    path.write_bytes(bytes(data))
    for checksum in path.parent.glob(f".{path.name}.crc"):
        checksum.unlink()


@pytest.mark.parametrize("batch", [None, "one"])
def test_damaged_pages_do_not_stop_a_build(spark, matches, tmp_path, rows, batch):
    """A file with a sound footer and broken pages is noted; all others, clashing types among them, are merged."""
    _write_match(spark, matches, "m 5", [("d", 1, 5, f"b{i}", "ak", "x") for i in range(50)], [("d", 2, "t")])
    clash = spark.createDataFrame([("d", 1, "7", "e7", "p90", 3)], "demo_file string, round int, tick string, event_id string, weapon string, extra int")
    clash.coalesce(1).write.parquet(f"{matches}/m6/events_shots")
    [broken] = (tmp_path / "matches" / "m 5" / "events_shots").glob("*.parquet")
    _damage(broken)
    root = str(tmp_path / "wh")
    for _ in range(2):
        assert warehouse.build(spark, matches, root, batch) == ["rounds", "events_shots"]
    shots = warehouse.read_table(spark, root, "events_shots").filter("event_id is not null")
    assert rows(shots, "match_id", "event_id") == [("m1", "e1"), ("m2", "e2"), ("m6", "e7")]
    assert warehouse.read_table(spark, root, "rounds").select("match_id").distinct().count() == 2
    [lost] = warehouse.read_rejected(spark, root).collect()
    assert lost.path.endswith(broken.name) and lost.table == "events_shots" and "of 50 rows" in lost.reason


def test_damaged(spark, tmp_path):
    frame = spark.range(20_000).selectExpr("id", "cast(id as string) AS name", "array(id) AS more", "map('k', id) AS pairs")
    frame.repartition(3).write.parquet(str(tmp_path / "t a"))
    frame.limit(0).coalesce(1).write.parquet(str(tmp_path / "t a" / "none"))
    (tmp_path / "t a" / "footer.parquet").write_text("broken")
    files = sorted((tmp_path / "t a").glob("part-*.parquet"))
    _damage(files[1])
    found = {os.path.basename(r.path): r.reason for r in damage.damaged(spark, [str(tmp_path / "t a")], frame.schema).collect()}
    assert set(found) == {files[1].name, "footer.parquet"} and all(found.values())
    assert bundles.read_bundle(spark, str(tmp_path), "t a", frame.schema, lenient=True).count() == 0
    files[1].unlink()
    (tmp_path / "t a" / "footer.parquet").unlink()
    assert bundles.read_bundle(spark, str(tmp_path), "t a", frame.schema, lenient=True).count() > 0


def test_a_merge_reads_only_the_folders_of_its_keys(spark, tmp_path, rows):
    root = str(tmp_path / "wh")
    loadouts = lambda matches: spark.createDataFrame(
        [(m, "d", r, f"s{p}") for m in matches for r in range(3) for p in range(5)], "match_id string, demo_file string, round int, steamid string"
    )
    warehouse.merge_into(spark, root, "round_loadouts", loadouts([f"m{i}" for i in range(200)]))
    stored = warehouse.read_table(spark, root, "round_loadouts")
    assert stored.count() == 3000
    batch = loadouts(["m7", "m7", "m500"])
    near = warehouse.near_keys(spark, root, "round_loadouts", batch)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(key_bucket" in plan or "key_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(match_id,m500)" in plan and "LessThanOrEqual(match_id,m7)" in plan
    folders = near.select("match_id").distinct().count()
    touched = batch.select(warehouse.key_bucket(["match_id"])).distinct().count()
    assert touched <= 2 and 0 < folders < 40
    warehouse.merge_into(spark, root, "round_loadouts", batch, batch="b1", incremental=True)
    merged = warehouse.read_table(spark, root, "round_loadouts")
    assert merged.count() == 3015 and merged.distinct().count() == 3015
    # A batch without any key is taken as it is.
    unkeyed = spark.createDataFrame([(None, "d", 1, "s")] * 2, "match_id string, demo_file string, round int, steamid string")
    for _ in range(2):
        warehouse.merge_into(spark, root, "round_loadouts", unkeyed, batch="b2", incremental=True)
    assert warehouse.read_table(spark, root, "round_loadouts").count() == 3017


def test_new_rows_reads_its_source_once(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.range(100).selectExpr("CASE WHEN id % 3 > 0 THEN concat('k', id % 50) END AS k", "cast(id as int) AS v")
    plan = warehouse.new_rows(target, source, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    assert warehouse.new_rows(target, source, ["k"]).filter("k is null").count() == 34
