"""File sources, image jobs and streams on generated files."""

import json
import struct
import zlib

import numpy as np
import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.operators import scoring
from sluice.sources import files, journal as J, sheets
from sluice.streaming import live


def png(path, array):
    h, w = array.shape[:2]
    raw = b"".join(b"\0" + array[y].tobytes() for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_journal_torn_line_and_last_entry(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"file":"x","blur":1.0}\n\n{"file":"y","blur":2.0}\n{"file":"z","bl')
    (tmp_path / "b.jsonl").write_text('{"file":"x","blur":5.0}\n{"file":"w","error":"bad"}\n')
    got = {r.file: (r.blur, r.error) for r in J.read_journal(spark, str(tmp_path)).collect()}
    assert got == {"x": (5.0, None), "y": (2.0, None), "w": (None, "bad")}


def test_results_in_three_shapes(spark, tmp_path):
    frame = lambda p, n: {"source_path": p, "fish_count": n, "detections": [{"detection": {"bbox": [0, 0, 1, 1], "confidence": 0.5}}]}
    (tmp_path / "1.json").write_text(json.dumps({"frames": [frame("a", 1), frame("b", 2)]}))
    (tmp_path / "2.json").write_text(json.dumps({"per_frame_results": [frame("c", 3)]}))
    (tmp_path / "3.json").write_text(json.dumps([frame("d", 4), {"source_path": "e", "detections": [{"bbox": [1, 2, 3, 4], "confidence": 0.7}]}]))
    rows = {r.source_path: r for r in J.plain_detections(J.read_results(spark, str(tmp_path))).collect()}
    assert {k: r.fish_count for k, r in rows.items()} == {"a": 1, "b": 2, "c": 3, "d": 4, "e": None}
    assert rows["e"].detections[0].bbox == [1, 2, 3, 4] and rows["a"].detections[0].class_name == "fish"


def test_labels_without_the_excluded_column(spark, tmp_path):
    (tmp_path / "labels.csv").write_text("frame_id,source,frame,box_index,origin,label,x1,y1,x2,y2,confidence\nf,r,f,0,missed,fish,1,2,3,4,\n")
    (tmp_path / "labeled_frames.csv").write_text("frame_id,source,frame,n_model_boxes\nf,r,f,2\n")
    boxes, frames = J.read_labels(spark, str(tmp_path))
    assert boxes.first().confidence is None and frames.first().excluded == "no"


def test_sheets(spark):
    data = spark.createDataFrame([("1", "Y", None), (None, None, None)], "image_id string, `countable (Y/N)` string, `Unnamed: 3` string")
    out = sheets.data_rows({"BRIDE wk": data, "Sites": data, "Other": data.select("Unnamed: 3")})
    assert out.columns == ["image_id", "countable", "sheet"] and out.count() == 1
    assert sheets.data_rows({"Sites": data}) is None
    assert [r.max_count for r in sheets.count_bins(spark).orderBy("bin_code").collect()] == [10, 100, 500, None]


def test_annotations_reviews_and_corrections(spark, tmp_path):
    task = [{"data": {"db_image_id": 7}, "annotations": [{"id": 1, "result": [{"type": "choices", "value": {"choices": ["No"]}}, {"type": "rectanglelabels", "value": {}}, {"type": "choices", "value": {"choices": ["Yes"]}}]}, {"id": None, "result": []}]}]
    (tmp_path / "t.json").write_text(json.dumps(task))
    from sluice.operators.catalog import annotation_label

    got = J.read_annotations(spark, str(tmp_path / "t.json")).withColumn("l", annotation_label("result")).collect()
    assert [(r.annotation_id, r.image_id, r.l.present, r.l.fish_boxes) for r in got] == [(1, 7, 1, 1)]
    sheet = spark.createDataFrame([("a.jpg", "River Herring"), ("b.jpg", " "), ("gone.jpg", "x")], "crop_path string, corrected_species string")
    train, missing = J.corrections_manifest(sheet, spark.createDataFrame([("a.jpg",)], "path string"))
    assert [tuple(r) for r in train.collect()] == [("a.jpg", "river_herring", "train")] and [r.crop_path for r in missing.collect()] == ["gone.jpg"]


def test_changed_settings_are_seen(spark):
    one = spark.createDataFrame([("m", 0.1, None)], "model string, conf double, iou double")
    assert not J.settings_changed(one, one)
    assert J.settings_changed(one, one.withColumn("conf", F.lit(0.2)))


def test_archive_scan_and_discovery(spark, tmp_path):
    solid = np.full((8, 8, 3), 9, np.uint8)
    for name in ("s1/a.png", "s1/a.PNG", "s2/b.png", "root.png", "out/x.png"):
        png(tmp_path / name, solid)
    (tmp_path / "s1/notes.txt").write_text("x")
    got = {(r.session, r.original_name): r.file_path for r in files.scan_archive(spark, str(tmp_path)).collect()}
    assert got == {("s1", "a"): "s1/a.png", ("s2", "b"): "s2/b.png", ("unsorted", "root"): "root.png", ("out", "x"): "out/x.png"}
    assert {r.file for r in files.discover(spark, str(tmp_path), "out").collect()} == {"s1/a.png", "s1/a.PNG", "s2/b.png", "root.png"}
    assert {r["class"] for r in files.class_folders(spark, [str(tmp_path / "s1"), str(tmp_path / "s2")]).collect()} == {"s1", "s2"}


def jpeg_with_exif(orientation, date):
    ifd = struct.pack("<H", 2) + struct.pack("<HHIHH", 0x0112, 3, 1, orientation, 0) + struct.pack("<HHII", 0x0132, 2, len(date) + 1, 38) + struct.pack("<I", 0)
    tiff = b"II*\0" + struct.pack("<I", 8) + ifd + date.encode() + b"\0"
    body = b"Exif\0\0" + tiff
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda"


def test_capture_times(spark):
    rows = [("a", jpeg_with_exif(6, "2024:05:01 10:20:30")), ("b", b"junk"), ("c", None), ("d", jpeg_with_exif(1, "yesterday"))]
    df = spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in rows], "path string, content binary")
    got = {r.path: (r.orientation, r.date_captured, r.time_captured) for r in files.capture_times(df).collect()}
    assert got == {"a": (6, "2024-05-01", "10:20:30"), "b": (1, None, None), "c": (1, None, None), "d": (1, None, None)}


def test_upright_turns():
    a = np.arange(6).reshape(2, 3, 1)
    assert (scoring.upright(a, 3) == a[::-1, ::-1]).all() and (scoring.upright(a, 6) == np.rot90(a, -1)).all() and (scoring.upright(a, 8) == np.rot90(a, 1)).all()
    assert (scoring.upright(a, 2) == a[:, ::-1]).all() and (scoring.upright(a, 4) == a[::-1]).all() and (scoring.upright(a, 5) == a.swapaxes(0, 1)).all()
    assert (scoring.upright(a, 7) == a.swapaxes(0, 1)[::-1, ::-1]).all()


def test_scoring_jobs(spark, tmp_path):
    def make_scorer():
        return lambda arrays: [[(0.5, 1.5, 4.5, 6.0, float(a.mean()) / 255), (0, 0, 1, 1, 0.01)] for a in arrays]

    png(tmp_path / "a.png", np.full((48, 64, 3), 128, np.uint8))
    png(tmp_path / "b.png", np.full((48, 64, 3), 255, np.uint8))
    (tmp_path / "c.png").write_bytes(b"not a picture")
    pics = files.images(spark, str(tmp_path)).withColumn("file", F.regexp_extract("origin", "([^/]*)$", 1))
    entries = {r.file: r for r in scoring.score_images(pics, make_scorer).collect()}
    assert entries["c.png"].error == "unreadable" and entries["a.png"].brightness == 128.0 and entries["a.png"].blur == 0.0
    assert [d.box for d in entries["b.png"].detections] == [[0, 2, 4, 6]] and entries["b.png"].width == 64
    table = scoring.score_images(pics, make_scorer)
    two = scoring.classify(table, pics, lambda: lambda crops: [("shad", 0.9, {"shad": 0.9}) for _ in crops]).collect()
    assert {(r.file, r.species) for r in two} == {("a.png", "shad"), ("b.png", "shad")}
    assert {r.species for r in scoring.classify(table, pics, None).collect()} == {"unknown_fish"}
    grid = spark.createDataFrame([("f", 100, 60)], "file string, width long, height long")
    assert sorted((r.tx, r.ty) for r in scoring.tile_grid(grid, 50, 0.0).collect()) == [(0, 0), (0, 10), (50, 0), (50, 10)]
    for extent in (1, 49, 50, 51, 99, 100, 150):
        grid = spark.createDataFrame([("f", extent, 60)], "file string, width long, height long")
        assert sorted({r.tx for r in scoring.tile_grid(grid, 50, 0.3).collect()}) == scoring.tile_starts(extent, 50, 35)
    boxes = np.array([[0, 0, 10, 10, 0.9], [1, 1, 11, 11, 0.8], [20, 20, 30, 30, 0.7]], float)
    assert len(scoring.merged(boxes)) == 2
    good = pics.filter("data IS NOT NULL")
    tiled = scoring.score_tiled(good, make_scorer, 32, 0.5).collect()
    assert tiled and all(r.x2 <= 64 for r in tiled)


def test_two_stages_in_one_look(spark, tmp_path):
    rng = np.random.default_rng(2)
    for k in range(9):
        png(tmp_path / f"{k}.png", rng.integers(0, 255, (40 + k, 64, 3)).astype(np.uint8))
    (tmp_path / "bad.png").write_bytes(b"no")

    def make_scorer():
        def score(arrays):
            if len(arrays) > 2:
                raise MemoryError
            return [[(-3.5, 1.5, 20.4, 30.5, float(a.mean()) / 255), (60, 30, 64.4, 90, 0.3), (5, 5, 5, 9, 0.9), (0, 0, 9, 9, 0.01)] for a in arrays]

        return score

    make_classifier = lambda: lambda crops: [("s", float(c.mean()), {"h": float(c.shape[0]), "w": float(c.shape[1])}) for c in crops]
    pics = files.images(spark, str(tmp_path)).withColumn("file", F.regexp_extract("origin", "([^/]*)$", 1)).withColumn("orientation", F.regexp_extract("file", "(\\d)", 1).try_cast("int"))
    one = scoring.two_stage(pics, make_scorer, make_classifier)
    two = scoring.classify(scoring.score_images(pics, make_scorer), pics, make_classifier)
    key = lambda d: sorted((r.file, r.box_id, r.confidence, r.species, r.class_confidence, sorted(r.probabilities.items())) for r in d.collect())
    assert key(one) == key(two) and one.count() >= 10
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    totals = scoring.run_batch(pics, make_scorer, str(tmp_path / "journal")).first()
    assert (totals.images, totals.unreadable, totals.images_with_fish, totals.total_fish) == (10, 1, 9, 27)
    assert totals.seconds > 0 and abs(totals.seconds_per_image * 10 - totals.seconds) < 1e-9
    none = scoring.run_batch(pics.limit(0), make_scorer, str(tmp_path / "none")).first()
    assert none.images == 0 and none.seconds_per_image is None


def test_pictures_of_very_many_tiles(spark):
    side = 1616
    a = np.zeros((side, side, 1), np.uint8)
    a[8::160, 8::160] = 255

    def make_scorer():
        def score(arrays):
            assert len(arrays) <= 16
            return [[(x - 2, y - 2, x + 2, y + 2, 0.5 + 0.4 * (x % 7) / 7) for y, x in zip(*np.nonzero(t[:, :, 0]))] for t in arrays]

        return score

    df = spark.createDataFrame([("big", side, side, 1, bytearray(a.tobytes()))], "file string, height int, width int, nChannels int, data binary")
    tiled = scoring.score_tiled(df, make_scorer, 32, 0.5)  # 100 x 100 tiles
    assert len(scoring.tile_starts(side, 32, 16)) ** 2 == 10_000
    got = {((r.x1 + r.x2) / 2, (r.y1 + r.y2) / 2) for r in tiled.collect()}
    assert got == {(float(x), float(y)) for y in range(8, side, 160) for x in range(8, side, 160)}
    assert "Exchange" not in tiled._jdf.queryExecution().executedPlan().toString()


# -- streams ----------------------------------------------------------------------------------------------------------


def run_stream(spark, df, name, tmp_path, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_live_counts_equal_the_batch_twin(spark, tmp_path):
    rows = spark.range(200).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 97).alias("ts"), F.concat(F.lit("s"), F.col("id") % 2).alias("species"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = {tuple(r) for r in run_stream(spark, live.binned_counts(stream), "bins", tmp_path)}
    batch = {tuple(r) for r in live.binned_counts(rows).collect()}
    assert got and got <= batch and len(batch) - len(got) <= 2  # the last bin of each species is still open


def test_settled_folders_and_first_of_each(spark, tmp_path):
    rows = spark.createDataFrame([("/d/a/1.jpg", 1000), ("/d/a/2.jpg", 1010), ("/d/b/3.jpg", 1100), ("/d/b/3.jpg", 1100)], "path string, t long").select("path", F.timestamp_seconds("t").alias("modificationTime"))
    got = {(r.folder, r.files) for r in live.settled_folders(rows).collect()}
    assert got == {("a", 2), ("b", 2)}
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert len(run_stream(spark, live.first_of_each(stream, "path", ts="modificationTime"), "once", tmp_path)) == 3
    assert {(r.folder, r.files) for r in run_stream(spark, live.settled_folders(stream), "settled", tmp_path)} == {("a", 2)}
    with pytest.raises(ValueError):
        live.first_of_each(stream, "path")
    assert live.first_of_each(rows, "path", rows.filter("path LIKE '%1.jpg'")).count() == 2


def in_batches(spark, folder, schema, *batches):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_pulls_are_exactly_once(spark, tmp_path):
    stream = in_batches(spark, tmp_path / "in", "id long, v string", [(1, "b"), (1, "a"), (None, "x")], [(2, "b"), (1, "again")], [])
    live.pull_once(stream, "id", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    table = live.pulled(spark, str(tmp_path / "out"), stream, "id")
    assert sorted(map(tuple, table.state().collect())) == [(1, "a"), (2, "b")]
    # a second stream with a fresh checkpoint adds to what is there
    more = in_batches(spark, tmp_path / "more", "id long, v string", [(2, "other"), (3, "c")])
    live.pull_once(more, "id", str(tmp_path / "out"), str(tmp_path / "cp2")).awaitTermination(120)
    assert sorted(map(tuple, table.state().collect())) == [(1, "a"), (2, "b"), (3, "c")]
    # and the first one goes on where it stopped
    spark.createDataFrame([(4, "d"), (3, "late")], "id long, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live.pull_once(stream, "id", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(map(tuple, table.state().collect())) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_review_set_follows_the_last_change(spark, tmp_path):
    batches = [(1, True, 1), (2, True, 2)], [(2, False, 3), (3, True, 4), (3, None, 5)], [(3, True, 6), (1, True, 7)]
    stream = in_batches(spark, tmp_path / "in", "image_id long, valid boolean, seq long", *batches)
    live.review_set(stream, "image_id", str(tmp_path / "set"), str(tmp_path / "cp")).awaitTermination(120)
    table = live.review_table(spark, str(tmp_path / "set"), stream, "image_id")
    assert sorted(r.image_id for r in table.state().collect()) == [1, 3]
    assert table._rows(table.manifest()["runs"]).filter("image_id = 1").count() == 1  # a change to what it is already adds nothing


def tag_stream(spark, session, folder, schema, *batches):
    in_batches(spark, folder, schema, *batches)
    return session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_tag_changes_stream(spark, tmp_path):
    schema, session = "image_id long, tags array<string>", live.state_session(spark)
    stream = tag_stream(spark, session, tmp_path / "in", schema, [(1, ["a", "b"]), (2, ["x"]), (3, ["new"]), (4, None), (None, ["z"])], [(3, ["new", "new"]), (4, ["t"])])
    seed = session.createDataFrame([(1, ["b", "a"]), (2, ["y"]), (9, ["never seen again"])], schema)
    got = {(r.image_id, tuple(r.tags)) for r in run_stream(session, live.tag_changes_stream(stream, seed), "tags", tmp_path)}
    assert got == {(2, ("x",)), (4, ("t",))}
    batch = spark.createDataFrame([(1, ["b", "a"]), (2, ["y"])], schema)
    assert {r.image_id for r in live.tag_changes(batch, spark.createDataFrame([(1, ["a", "b"]), (2, ["x"])], schema)).collect()} == {2}


def test_tag_snapshots_follow_their_order_and_are_forgotten(spark, tmp_path):
    import time
    from datetime import timedelta

    schema, session = "image_id long, tags array<string>, seq long", live.state_session(spark)
    rows = [(1, ["a"], 3), (1, ["b"], 2), (1, ["a"], 1), (2, ["x"], 1)], [(1, ["b"], 2), (2, ["y"], 2)]
    stream = tag_stream(spark, session, tmp_path / "in", schema, *rows)
    got = [(r.image_id, tuple(r.tags)) for r in run_stream(session, live.tag_changes_stream(stream, order="seq"), "ordered", tmp_path)]
    assert sorted(got) == [(1, ("a",)), (1, ("b",)), (2, ("y",))]  # the late snapshot of image 1 is passed over

    def remembered(rows, out):
        stream = tag_stream(spark, session, tmp_path / "two", schema, rows)
        found = live.tag_changes_stream(stream, order="seq", keep=timedelta(seconds=1))
        query = found.writeStream.format("parquet").option("path", str(tmp_path / out)).option("checkpointLocation", str(tmp_path / "cp-forgetful")).trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        return session.read.schema("image_id long, tags array<string>").parquet(str(tmp_path / out)).count()

    assert remembered([(1, ["a"], 1), (2, ["x"], 1)], "out") == 0
    time.sleep(2)
    assert remembered([(1, ["b"], 2)], "out") == 0  # the image was forgotten, so the snapshot seeds it anew


def test_only_settled_folders_are_ingested_and_a_failed_push_stays_pending(spark, tmp_path):
    pushed = []

    def push(tasks):
        if not pushed:
            pushed.append(None)
            raise RuntimeError("away")
        pushed.extend((r.file_path, r.task_key) for r in tasks.collect())

    for name in ("W1/a.jpg", "W1/a.png", "W1/n.txt", "w1/b.jpg", "W2/a.jpg", "W3/c.jpg"):
        (tmp_path / "drop" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "drop" / name).write_bytes(name.encode())
    loop = live.FolderIngest(spark, str(tmp_path / "drop"), str(tmp_path / "store"), push)
    at = lambda name, t: (f"{tmp_path}/drop/{name}", datetime.datetime.fromtimestamp(t))
    stream = in_batches(
        spark, tmp_path / "in", "path string, modificationTime timestamp", [at("W1/a.jpg", 1000), at("W1/a.png", 1005), at("W1/n.txt", 1100)],
        [at("w1/b.jpg", 1200), at("W2/a.jpg", 1210)], [at("W3/c.jpg", 1300)],
    )
    loop.run(stream, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(p for p, _ in pushed[1:]) == ["W1/a.png", "W2/a.jpg", "w1/b.jpg"] and len({k for _, k in pushed[1:]}) == 3
    assert {(r.session_id, r.label) for r in loop.sessions.state().collect()} == {(1, "W1"), (2, "W2")}  # W3 may still grow
    images = {r.file_path: r for r in loop.images.state().collect()}
    assert set(images) == {"W1/a.png", "w1/b.jpg", "W2/a.jpg"} and images["w1/b.jpg"].session_id == 1
    assert images["W2/a.jpg"].file_size == 8 and images["W2/a.jpg"].content_hash == hashlib.sha256(b"W2/a.jpg").hexdigest()
    assert loop.pending.state().count() == 0
    # a batch that comes again after a loss leaves the same rows
    before = [sorted(map(str, t.state().collect())) for t in (loop.sessions, loop.images, loop.pending)]
    name = live.stream_name(spark, str(tmp_path / "cp"))
    last = max(m["batch"] for m in loop.images.manifest()["streams"].values())
    loop.ingest(spark.createDataFrame([("W2",)], "folder string"), name, last)
    loop.ingest(spark.createDataFrame([("W1",)], "folder string"), "another stream", 0)
    assert [sorted(map(str, t.state().collect())) for t in (loop.sessions, loop.images, loop.pending)] == before
    add, drop = live.add_and_prune(spark.createDataFrame([(1,), (2,)], "image_id long"), spark.createDataFrame([(2,), (3,)], "image_id long"))
    assert [r.image_id for r in add.collect()] == [3] and [r.image_id for r in drop.collect()] == [1]


def test_a_run_resumes_and_refuses_other_settings(spark, tmp_path):
    schema = "file string"
    score = lambda d: d.selectExpr("file", "1L AS width", "1L AS height", "0D AS blur", "0D AS brightness", "if(file LIKE '%bad%', 'unreadable', null) AS error", "array(named_struct('box', array(0L, 0L, 1L, 1L), 'confidence', 0.5D)) AS detections")
    run = lambda stream, **s: live.resumable_run(stream, score, {"conf": 0.1, "model": "m"} | s, str(tmp_path / "journal"), str(tmp_path / "cp"))
    stream = in_batches(spark, tmp_path / "in", schema, [("a",), ("bad",)])
    run(stream).awaitTermination(120)
    more = in_batches(spark, tmp_path / "in", schema, [("b",)])
    run(more).awaitTermination(120)
    with pytest.raises(live.SettingsChanged, match="conf: 0.1 before, 0.2 now"):
        run(more, conf=0.2)
    entries = spark.read.json(str(tmp_path / "journal")).collect()
    assert sorted((r.file, getattr(r, "error", None)) for r in entries) == [("a", None), ("b", None), ("bad", "unreadable")]


@pytest.fixture(autouse=True)
def _clean(spark):
    yield
    for t in spark.catalog.listTables():
        spark.catalog.dropTempView(t.name)
