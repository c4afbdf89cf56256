"""Runs that stop and go on."""

import os

import pytest

from conftest import SF_SMALL
from panelkit.operators import ml as ML
from panelkit.operators import split as S
from panelkit.plans import cli, stages
from panelkit.plans.q_labels import labelled
from panelkit.plans.resume import Resumable
from panelkit.sources.io import read_table, write_table


def stop(*_, **__):
    raise RuntimeError("stopped")


@pytest.fixture(scope="module")
def data(spark, tmpdir_session):
    return write_table(labelled(spark, SF_SMALL), os.path.join(tmpdir_session, "resume_data.parquet"))


def train(spark, data, folder, **kw):
    run = Resumable(spark, folder, [data], kw.pop("version", ""))
    return run, stages.train_and_evaluate(read_table(spark, data), resume=run, **kw)


def rows(res):
    return sorted(tuple(r) for r in res.metrics.collect())


def test_a_run_goes_on_from_the_written_split(spark, data, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    want = rows(stages.train_and_evaluate(read_table(spark, data)))
    with monkeypatch.context() as m:
        m.setattr(ML, "fit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            train(spark, data, folder)
    with monkeypatch.context() as m:                 # the split is not computed again
        m.setattr(S, "firm_level_split", stop)
        run, res = train(spark, data, folder)
        assert (run.found, run.computed) == (["split"], ["model"]) and rows(res) == want
        m.setattr(ML, "fit", stop)                   # nor is the model fitted again
        run, res = train(spark, data, folder)
        assert (run.found, run.computed) == (["split", "model"], []) and rows(res) == want


def test_other_parameters_run_what_depends_on_them(spark, data, tmp_path):
    folder = str(tmp_path / "run")
    train(spark, data, folder)
    run, _ = train(spark, data, folder, cfg=ML.ModelConfig(C=0.5))
    assert (run.found, run.computed) == (["split"], ["model"])
    run, _ = train(spark, data, folder, cfg=ML.ModelConfig(C=0.5), ratios=(0.6, 0.2, 0.2))
    assert run.computed == ["split", "model"]
    run, _ = train(spark, data, folder, cfg=ML.ModelConfig(C=0.5), ratios=(0.6, 0.2, 0.2), version="2")
    assert run.computed == ["split", "model"]


def test_changed_inputs_run_again(spark, tmp_path):
    path, folder = str(tmp_path / "in.parquet"), str(tmp_path / "run")
    write_table(spark.range(5), path)
    ask = lambda: (lambda r: (r, r.table("t", lambda: read_table(spark, path)).count()))(
        Resumable(spark, folder, [path]))
    assert [ask()[1], ask()[0].found] == [5, ["t"]]
    write_table(spark.range(7), path)
    run, n = ask()
    assert n == 7 and run.computed == ["t"]


def test_a_model_that_was_not_saved_whole_is_fitted_again(spark, data, tmp_path, monkeypatch):
    folder = str(tmp_path / "run")
    train(spark, data, folder)
    with monkeypatch.context() as m:                 # another fit dies while it is saved
        m.setattr(ML.FittedModel, "save", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            train(spark, data, folder, cfg=ML.ModelConfig(C=0.5))
    run, _ = train(spark, data, folder)
    assert run.computed == ["model"]


def test_a_stage_that_fails_leaves_the_finished_one(spark, tmp_path):
    path, folder = str(tmp_path / "in.parquet"), str(tmp_path / "run")
    write_table(spark.range(5), path)
    Resumable(spark, folder, [path]).table("t", lambda: spark.range(5))
    with pytest.raises(RuntimeError, match="stopped"):
        Resumable(spark, folder, [path]).table("t", stop, other=1)
    run = Resumable(spark, folder, [path])
    assert run.table("t", stop).count() == 5 and run.found == ["t"]


def test_missing_inputs_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Resumable(spark, str(tmp_path), [str(tmp_path / "none.parquet")])


def test_cli_train_resumes(spark, data, tmp_path):
    folder = str(tmp_path / "kept")
    argv = ["train", "--data", data, "--max-iter", "50", "--resume", folder, "--out"]
    first = cli.run([*argv, str(tmp_path / "a.parquet")], spark)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ML, "fit", stop)
        second = cli.run([*argv, str(tmp_path / "b.parquet")], spark)
    both = [sorted(map(tuple, read_table(spark, p).collect())) for p in (first, second)]
    assert both[0] == both[1]
