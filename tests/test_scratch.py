"""Scratch folders: owned by a run, gone after it, also after an error; what lost drivers leave is swept."""

import os
import time

import pytest

from bindings import inputs as I
from tests.conftest import SF
from triagelake import session
from triagelake.plans import jobs
from triagelake.session import RUN_PREFIX, cut_lineage, run_folder, scratch_path, sweep_runs


def _root(spark):
    return session.shared_folder(spark).removeprefix("file:")


@pytest.fixture(autouse=True)
def own_folder(monkeypatch, tmp_path):
    """A shared folder for each test alone."""
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file:{tmp_path}")


def test_a_run_ends_without_its_tables(spark):
    before = set(os.listdir(_root(spark)))
    with run_folder(spark) as path:
        with run_folder(spark, "inner") as inner:
            assert inner.startswith(path) and cut_lineage(spark.range(5), "five").count() == 5
        assert not os.path.exists(inner.removeprefix("file:")) and cut_lineage(spark.range(3), "three").count() == 3
        assert scratch_path(spark, "x").startswith(path) and os.path.exists(path.removeprefix("file:"))
    assert set(os.listdir(_root(spark))) == before and not scratch_path(spark, "x").startswith(path)


def test_a_failed_run_ends_without_its_tables(spark):
    with pytest.raises(ValueError, match="own error"), run_folder(spark) as path:
        cut_lineage(spark.range(3), "three")
        raise ValueError("own error")
    assert not os.path.exists(path.removeprefix("file:"))
    with run_folder(spark):
        pass  # nothing written, nothing to delete


def test_jobs_leave_no_scratch(spark):
    out = scratch_path(spark, "corpus-out")
    before = set(os.listdir(_root(spark)))
    pool, kb = jobs.prepare_corpus(I.whole_transcripts(spark, SF), out, holdout=5)
    assert pool.count() == 5 and kb.count() > 0
    assert set(os.listdir(_root(spark))) - before == {os.path.basename(out)}
    with pytest.raises(Exception):
        jobs.prepare_corpus(I.whole_transcripts(spark, SF).drop("conversation"), f"{out}-none", holdout=5)
    assert os.listdir(_root(spark)) == [os.path.basename(out)]


def test_a_local_session_without_a_folder_gets_one(spark):
    folder = session._own_folder(spark)
    assert os.path.isdir(folder.removeprefix("file:")) and session._own_folder(spark) == folder


def test_sweep_takes_old_runs_of_others_only(spark):
    root, week = _root(spark), 8 * 86400
    own = f"{RUN_PREFIX}{spark.sparkContext.applicationId}-job-a"
    for name in (f"{RUN_PREFIX}app-1-job-old", f"{RUN_PREFIX}app-2-job-new", own, "index-old"):
        os.makedirs(f"{root}/{name}/table")
        if not name.endswith("new"):
            os.utime(f"{root}/{name}", (time.time() - week,) * 2)
    assert sweep_runs(spark) == [f"{RUN_PREFIX}app-1-job-old"]
    assert {f"{RUN_PREFIX}app-2-job-new", own, "index-old"} <= set(os.listdir(root))
