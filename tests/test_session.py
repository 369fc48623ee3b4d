import tempfile
from types import SimpleNamespace

import pytest

from ledgerloom import session
from tools.compare import compare, connect


def fake(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_scratch_data_goes_to_the_shared_folder():
    path = session.scratch_path(fake("yarn", spark_checkpoint_dir="s3a://shared/cut/"), "x")
    assert path.startswith("s3a://shared/cut/x-")
    assert path != session.scratch_path(fake("yarn", spark_checkpoint_dir="s3a://shared/cut/"), "x")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(fake("yarn"), "x")
    assert session.scratch_path(fake("local[2]"), "x").startswith(tempfile.gettempdir())


@pytest.mark.parametrize("name", ["raw_event_ids", "stg_unmatched_events", "mrr_kpis"])
def test_results_do_not_depend_on_the_session_zone(spark, folder, name):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert compare(spark, connect(folder), folder, name) == []
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"

