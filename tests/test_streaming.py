import json

from buildmend.streaming import watch

RUNS = "repo string, run_id bigint, conclusion string, created_at timestamp, ci_log string"


def land(folder, name, runs):
    (folder / name).write_text("\n".join(json.dumps(r) for r in runs))


def run(i, conclusion="failure", log="timed out"):
    return {"repo": "o/r", "run_id": i, "conclusion": conclusion, "created_at": f"2024-01-{1 + i % 20:02d}T00:00:00Z", "ci_log": log}


def test_runs_seen_again_are_handled_once(spark, tmp_path):
    landing, output, progress = (tmp_path / n for n in ("in", "out", "progress"))
    landing.mkdir()

    def poll():
        landed = watch.landed_files(spark, str(landing), RUNS, files_per_batch=1)
        watch.watch_failures(landed, str(output), str(progress), once=True).awaitTermination()
        rows = spark.read.parquet(str(output)).collect()
        return sorted((r.run_id, r.failure_class) for r in rows)

    land(landing, "a.json", [run(1), run(2, "success"), run(3, log="deadlock")])
    land(landing, "b.json", [run(1), run(3), run(4, log="fine")])
    assert poll() == [(1, "FLAKY"), (3, "FLAKY"), (4, "UNKNOWN")]
    # A restart goes on from its progress: what landed before is not taken again.
    land(landing, "c.json", [run(1), run(5, log="manifest unknown")])
    assert poll() == [(1, "FLAKY"), (3, "FLAKY"), (4, "UNKNOWN"), (5, "ENV")]


def test_files_that_land_newest_first_lose_no_run(spark, tmp_path):
    landing, output, progress = (tmp_path / n for n in ("in", "out", "progress"))
    landing.mkdir()
    for i in reversed(range(6)):
        land(landing, f"{i}.json", [run(i) | {"created_at": f"20{10 + i}-01-01T00:00:00Z"}, run(9)])
        watch.watch_failures(watch.landed_files(spark, str(landing), RUNS, files_per_batch=1), str(output), str(progress), once=True).awaitTermination()
    assert sorted(r.run_id for r in spark.read.parquet(str(output)).collect()) == [0, 1, 2, 3, 4, 5, 9]


def test_incomplete_requests_are_rejected(spark, tmp_path):
    landing, output = tmp_path / "in", tmp_path / "out"
    landing.mkdir()
    land(landing, "a.json", [{"repo": "o/r", "run_id": 5}, {"repo": "", "run_id": 5}, {"repo": "o/r"}, {"repo": "o/r", "run_id": 0}])
    checked = watch.repair_requests(watch.landed_files(spark, str(landing), "repo string, run_id bigint"))
    watch.run_to_files(checked, str(output), str(tmp_path / "p"), ["status"], once=True).awaitTermination()
    rows = spark.read.parquet(str(output)).collect()
    assert sorted((r.status, r.error) for r in rows if r.status == "queued") == [("queued", None)]
    assert [r.error for r in rows if r.status == "rejected"] == ["repo and run_id required"] * 3


def polled(spark, landing, output, progress, **options):
    """One poll; returns its progress."""
    landed = watch.landed_files(spark, str(landing), RUNS, **options)
    query = watch.watch_failures(landed, str(output), str(progress), once=True)
    query.awaitTermination()
    return query.recentProgress


def test_a_poll_reads_what_landed_and_not_the_table(spark, tmp_path):
    landing, output, progress = (tmp_path / n for n in ("in", "out", "progress"))
    landing.mkdir()
    counts = []
    for i in range(3):
        land(landing, f"{i}.json", [run(n) for n in range(i * 50, i * 50 + 60)])
        told = [p for p in polled(spark, landing, output, progress) if p["numInputRows"]]
        assert [p["numInputRows"] for p in told] == [60]
        state = told[0]["stateOperators"][0]
        counts.append((state["numRowsTotal"], state["numRowsUpdated"]))
        assert "rocksdbPutCount" in state["customMetrics"]
    # The state has a key for each run; a poll adds those that are new.
    assert counts == [(60, 60), (110, 50), (160, 50)]
    assert sorted(r.run_id for r in watch.watched(spark, str(output), RUNS).collect()) == list(range(160))


def test_a_batch_that_is_tried_again_adds_nothing_twice(spark, tmp_path):
    """The driver ends between the commit of the table and that of the progress."""
    landing, output, progress = (tmp_path / n for n in ("in", "out", "progress"))
    landing.mkdir()
    land(landing, "a.json", [run(1), run(2)])
    polled(spark, landing, output, progress)
    land(landing, "b.json", [run(2), run(3), run(4, log="deadlock")])
    polled(spark, landing, output, progress)
    commits = sorted((progress / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for kept in (progress / "commits").glob(f"*{commits[-1].name}*"):
        kept.unlink()
    polled(spark, landing, output, progress)
    assert sorted(r.run_id for r in watch.watched(spark, str(output), RUNS).collect()) == [1, 2, 3, 4]
    # And what comes later goes on from there.
    land(landing, "c.json", [run(1), run(3), run(5)])
    polled(spark, landing, output, progress)
    assert sorted(r.run_id for r in watch.watched(spark, str(output), RUNS).collect()) == [1, 2, 3, 4, 5]


def test_runs_without_keys_and_runs_known_before(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    land(landing, "a.json", [run(0) | {"run_id": None}, run(7) | {"run_id": None}, run(1), run(2), run(3, "success")])
    known = spark.createDataFrame([("o/r", 2)], "repo string, run_id long")
    landed = watch.landed_files(spark, str(landing), RUNS)
    watch.watch_failures(landed, str(tmp_path / "out"), str(tmp_path / "p"), once=True, known=known).awaitTermination()
    assert sorted(str(r.run_id) for r in watch.watched(spark, str(tmp_path / "out"), RUNS).collect()) == ["1", "None"]


def test_no_failure_yet_and_settings_stay(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    land(landing, "a.json", [run(1, "success")])
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    polled(spark, landing, tmp_path / "out", tmp_path / "p")
    assert watch.watched(spark, str(tmp_path / "out"), RUNS).collect() == []
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
