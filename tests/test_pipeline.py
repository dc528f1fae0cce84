import glob
import os
import tempfile

from conftest import SF001
from lapse.plans.run import OUTPUTS, run_pipeline


def test_pipeline_writes_every_output(spark):
    out = tempfile.mkdtemp(prefix="lapse-run-", dir="/tmp")
    paths = run_pipeline(spark, SF001, out)
    assert set(paths) == set(OUTPUTS)
    for name, path in paths.items():
        files = [f for f in glob.glob(f"{path}/**/part-*", recursive=True) if os.path.getsize(f) > 0]
        assert files, name
    mt = spark.read.parquet(paths["model_table"])
    assert {r.split for r in mt.select("split").distinct().collect()} == {"train", "val", "test"}
    assert mt.count() == spark.read.parquet(f"{SF001}/customer.parquet").count()


def test_cli_runs_one_query(tmp_path):
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "lapse.plans.run", "--root", SF001, "--query", "label_balance",
                          "--out", str(tmp_path / "lb")], cwd=repo, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert glob.glob(str(tmp_path / "lb" / "part-*"))


def _times(out):
    return {name: max(os.path.getmtime(f) for f in glob.glob(f"{out}/{name}/**/part-*", recursive=True)) for name in OUTPUTS}


def test_a_killed_run_goes_on_after_its_last_stage(spark, tmp_path, monkeypatch):
    """The run dies after the model table; the next one keeps that and does the rest, a third does nothing."""
    from lapse.plans import run as rn

    out = str(tmp_path / "out")

    def killed(r):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setitem(rn.STAGES, "baselines", (killed, rn.STAGES["baselines"][1]))
        try:
            run_pipeline(spark, SF001, out)
        except KeyboardInterrupt:
            pass
    assert os.path.exists(f"{out}/_stages/features") and not os.path.exists(f"{out}/model_metrics")
    kept = max(os.path.getmtime(f) for f in glob.glob(f"{out}/model_table/**/part-*", recursive=True))
    run_pipeline(spark, SF001, out, resume=True)
    first = _times(out)
    assert first["model_table"] == kept
    run_pipeline(spark, SF001, out, resume=True)
    assert _times(out) == first
    # another budget changes every fingerprint: nothing of the old run is taken for the new one's
    other = rn.fingerprint(rn.Context(spark, SF001, rn.Params(seed=7)), "features", "")
    assert open(f"{out}/_stages/features").read() != other


def test_outputs_of_the_report(spark, tmp_path):
    out = str(tmp_path / "out")
    paths = run_pipeline(spark, SF001, out)
    cal = {r.method: r for r in spark.read.json(paths["calibration_results"]).collect()}
    assert set(cal) == {"uncalibrated", "temperature", "isotonic"} and cal["temperature"].temperature > 0
    assert all(0 <= r.ece <= 1 and r.n > 0 for r in cal.values())
    policies = {r.policy: int(r.n_selected) for r in spark.read.option("header", True).csv(paths["budget_policies"]).collect()}
    n_test = spark.read.parquet(paths["calibrated_predictions"]).count()
    assert set(policies.values()) == {min(1000, n_test)}  # 50,000 at 50 each
    models = {r.model_id for r in spark.read.option("header", True).csv(paths["learned_ablation"]).collect()}
    assert models == {"mllib_logistic", "mllib_linear", "mllib_fm", "mllib_fm_value", "learned_joint"}
    bins = spark.read.option("header", True).csv(paths["reliability_bins"])
    assert bins.count() == 10


def test_manifest_with_other_windows_or_columns_is_refused(spark, tmp_path):
    import dataclasses
    import datetime as dt

    import pytest

    from lapse.config import Windows
    from lapse.operators.learn import Learners, vectorised
    from lapse.operators.modeltable import SCALED_COLS, UNSCALED_COLS, full_manifest
    from lapse.sources.sinks import Manifest, read_manifest, write_json

    cmap = spark.createDataFrame([("city", "1", 0, 3), ("gender", "f", 0, 2)], "feature string, value string, code int, cardinality int")
    w = Windows(feature_cutoff=dt.date(2001, 1, 31))
    write_json(full_manifest(cmap, w), str(tmp_path / "m"))
    m = Manifest.of(read_manifest(spark, str(tmp_path / "m")))
    assert m.windows == w and m.scaled == tuple(SCALED_COLS) and m.unscaled == tuple(UNSCALED_COLS)
    assert m.cardinality == {"city_enc": 3, "gender_enc": 2} and m.check(w) is m
    with pytest.raises(ValueError, match="built for"):
        m.check(Windows())
    table = spark.createDataFrame([(1, 0, 1.0, 1.0, 0, 0, 0.5, "train")], "user_key long, is_churn int, ltv double, log1p_ltv double, "
                                  "city_enc int, gender_enc int, x_scaled double, split string")
    with pytest.raises(ValueError, match="lacks"):
        Learners(table, m).features
    # another column list is obeyed
    own = dataclasses.replace(m, scaled=("x_scaled",), unscaled=())
    assert vectorised(table, own).first().features.size == 4 + 3 + 1


def test_sql_over_the_views_runs_no_job_of_its_own(spark):
    from lapse.plans.context import Context

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sql-surface", "views")
    df = Context(spark, SF001).sql("SELECT l.is_churn, count(*) AS n FROM label l JOIN members USING (user_key) JOIN nation ON city = n_nationkey GROUP BY 1")
    assert list(tracker.getJobIdsForGroup("sql-surface")) == []
    assert sum(r.n for r in df.collect()) == spark.read.parquet(f"{SF001}/customer.parquet").count()
    spark.sparkContext.setJobGroup("", "")
