import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerloom.sources import cleanup
from ledgerloom.sources.tables import RunFolder

UTC = dt.timezone.utc


def aged(path, days):
    then = (dt.datetime.now(UTC) - dt.timedelta(days=days)).timestamp()
    os.utime(path, (then, then))


def test_old_runs_go_and_the_published_one_stays(spark, tmp_path):
    root = str(tmp_path / "out")
    runs = [RunFolder(spark, root) for _ in range(4)]
    for number, run in enumerate(runs):
        for name in ("a", "b"):
            run.keep(name, spark.range(1).select(F.lit(number).alias("v")))
            aged(f"{root}/{name}/run_id={run.run_id}", 10 - number)
        run.checked = True
    (tmp_path / "out" / "a" / "notes").mkdir()
    runs[1].publish("cleaned")
    assert [r.name for r in cleanup.runs_in(spark, root)] == [r.run_id for r in runs]
    assert all(len(r.paths) == 2 for r in cleanup.runs_in(spark, root))
    assert cleanup.remove_old_runs(spark, root, "cleaned", keep=1) == [runs[0].run_id, runs[2].run_id]
    assert [r.name for r in cleanup.runs_in(spark, root)] == [runs[1].run_id, runs[3].run_id]
    assert [r["v"] for r in spark.table("cleaned.a").collect()] == [1]
    assert cleanup.remove_old_runs(spark, root, "cleaned", keep=1) == []
    assert (tmp_path / "out" / "a" / "notes").exists()


def test_runs_without_a_published_one_and_a_missing_root(spark, tmp_path):
    root = str(tmp_path / "out")
    for _ in range(2):
        RunFolder(spark, root).keep("a", spark.range(1))
    assert len(cleanup.remove_old_runs(spark, root, "never_published", keep=2)) == 0
    assert len(cleanup.remove_old_runs(spark, root, "never_published", keep=0)) == 2
    assert cleanup.runs_in(spark, str(tmp_path / "nowhere")) == []
    assert cleanup.scratch_in(spark, str(tmp_path / "nowhere")) == []


def test_scratch_folders_older_than_a_time_go(spark, tmp_path):
    names = {f"batch-{'a' * 32}": 9, f"stored-{'b' * 32}": 1, "my-own-folder": 99, "c" * 32: 99}
    for name, days in names.items():
        (tmp_path / name).mkdir()
        aged(tmp_path / name, days)
    assert [f.name for f in cleanup.scratch_in(spark, str(tmp_path))] == [f"batch-{'a' * 32}", f"stored-{'b' * 32}"]
    before = dt.datetime.now(UTC) - dt.timedelta(days=5)
    assert cleanup.remove_old_scratch(spark, str(tmp_path), before) == [f"batch-{'a' * 32}"]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(set(names) - {f"batch-{'a' * 32}"})
