"""Run the whole pipeline and write its deliverables (S7-S10), stage by stage and resumable (S3).

    python -m lapse.plans.run --root /path/to/tables --out /shared/output [--resume]
    python -m lapse.plans.run --root /path/to/tables --query auc_by_model
    python -m lapse.plans.run --root /path/to/tables --sql "SELECT city, count(*) FROM members GROUP BY city"

Stages: features (model table, Parquet per split, and manifest) -> baselines (closed-form metrics, ablation) ->
learn (heads trained from the written model table and manifest, their predictions, metrics and ablation) ->
calibrate (isotonic and temperature, errors before and after, reliability bins, curves, final metrics) ->
decide (priority scores, segments, budget policies, sensitivity, sample of actual against predicted value).

A stage that has ended leaves a marker with its fingerprint: the parameters, the input tables' sizes, and the
fingerprint of the stage before it.  With ``resume``, stages whose marker agrees are skipped and what they
wrote is read back; the first that does not, and all after it, are done again.  Every output is written by
the executors; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.config import DEFAULT, Params
from lapse.operators import calibrate as cb
from lapse.operators import decide as dc
from lapse.operators import metrics as me
from lapse.operators import scoring as sc
from lapse.plans.context import Context
from lapse.sources.buckets import USER_KEY
from lapse.sources.files import delete, path_exists, read_text, stored_bytes, write_text
from lapse.sources.sinks import read_manifest, read_model_split, write_csv, write_json, write_model_table
from lapse.sources.store import scope
from lapse.sources.tables import table_path

CALIBRATION_METHODS = {"uncalibrated": "score", "temperature": "p_temp", "isotonic": "p_iso"}


@dataclass
class Run:
    """One pipeline run: where its outputs are and how they are written."""

    c: Context
    out: str
    mode: str

    @property
    def spark(self) -> SparkSession:
        return self.c.spark

    def path(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"

    def json(self, df: DataFrame, name: str) -> None:
        write_json(df, self.path(name), self.mode)

    def csv(self, df: DataFrame, name: str) -> None:
        write_csv(df, self.path(name), self.mode)

    def parquet(self, df: DataFrame, name: str) -> None:
        write_model_table(df, self.path(name), self.mode)


def features(r: Run) -> None:
    r.parquet(r.c.model_table, "model_table")
    r.json(r.c.manifest.coalesce(1), "feature_manifest")


def baselines(r: Run) -> None:
    r.json(r.c.metrics, "model_metrics")
    r.csv(me.model_comparison(r.c.metrics, sc.CHURN_CEILING_MODEL, sc.VALUE_CEILING_MODEL), "ablation")


def learn(r: Run) -> None:
    """The learned heads read what was written, like a job of its own would."""
    r.c.model_table, r.c.manifest = r.spark.read.parquet(r.path("model_table")), read_manifest(r.spark, r.path("feature_manifest"))
    heads = r.c.learned_heads
    r.parquet(heads.filter(F.col("model_id") == "learned_joint"), "learned_predictions")
    metrics = me.model_metrics(heads, plan=r.c.plan)
    r.json(metrics, "learned_metrics")
    stored = r.spark.read.schema(metrics.schema).json(r.path("learned_metrics"))
    r.csv(me.model_comparison(stored, "mllib_logistic", "mllib_linear"), "learned_ablation")


def calibrate(r: Run) -> None:
    split = lambda s: read_model_split(r.spark, r.path("learned_predictions"), s)
    t = cb.rounded(cb.temperature_fit(split("val")))
    cal = cb.temperature_apply(cb.isotonic_apply(cb.isotonic_fit(split("val")), split("test")), t)
    r.parquet(cal, "calibrated_predictions")
    cal = read_model_split(r.spark, r.path("calibrated_predictions"), "test")
    r.json(me.calibration_results(cal, CALIBRATION_METHODS, t, r.c.p.n_reliability_bins), "calibration_results")
    r.csv(me.reliability_bins(cal, r.c.p.n_reliability_bins, prob="p_iso"), "reliability_bins")
    final = cal.withColumns({"model_id": F.lit("learned_isotonic"), "score": F.col("p_iso")})
    r.json(me.model_metrics(final, plan=r.c.plan), "final_model_metrics")
    curve = me.score_curve(final, plan=r.c.plan)
    r.csv(me.roc_points(curve), "roc_curve")
    r.csv(me.pr_points(curve), "pr_curve")


def decide(r: Run) -> None:
    p, plan = r.c.p, r.c.plan
    cal = read_model_split(r.spark, r.path("calibrated_predictions"), "test")
    ranked = dc.priority_scores(cal, plan=plan)
    r.csv(ranked, "retention_priority_scores")
    ranked = r.spark.read.schema(ranked.schema).option("header", True).csv(r.path("retention_priority_scores"))
    r.csv(dc.segment_representatives(ranked), "segments")
    r.csv(dc.budget_policies(ranked, p.budget, p.seed), "budget_policies")
    changes = dc.rank_changes(ranked, p.budget.n_interventions, p.sensitivity_pct, plan=plan)
    r.csv(changes, "rank_changes")
    changes = r.spark.read.schema(changes.schema).option("header", True).csv(r.path("rank_changes"))
    r.json(dc.rank_sensitivity(changes, p.budget.n_interventions), "rank_sensitivity")
    r.csv(dc.value_scatter_sample(cal, p.scatter_rows, p.seed), "value_scatter_sample")


STAGES: dict[str, tuple[Callable[[Run], None], tuple[str, ...]]] = {
    "features": (features, ("model_table", "feature_manifest")),
    "baselines": (baselines, ("model_metrics", "ablation")),
    "learn": (learn, ("learned_predictions", "learned_metrics", "learned_ablation")),
    "calibrate": (calibrate, ("calibrated_predictions", "calibration_results", "reliability_bins", "final_model_metrics", "roc_curve", "pr_curve")),
    "decide": (decide, ("retention_priority_scores", "segments", "budget_policies", "rank_changes", "rank_sensitivity", "value_scatter_sample")),
}
OUTPUTS = tuple(name for _, outputs in STAGES.values() for name in outputs)


def fingerprint(c: Context, stage: str, before: str) -> str:
    """Changes with the parameters, the input tables, the stage and everything before it."""
    sizes = {name: stored_bytes(c.spark, table_path(c.root, name)) for name in USER_KEY}
    return hashlib.sha256(json.dumps([stage, before, c.root, repr(c.p), sizes]).encode()).hexdigest()


def run_pipeline(spark: SparkSession, root: str, out: str, mode: str = "error", params: Params = DEFAULT,
                 resume: bool = False) -> dict[str, str]:
    """Every output's path.  With ``resume``, finished stages of an earlier run with the same parameters and inputs stay."""
    with scope(spark):
        r = Run(Context(spark, root, params), out, "overwrite" if resume else mode)
        before, valid = "", resume
        for name, (stage, outputs) in STAGES.items():
            marker = r.path(f"_stages/{name}")
            before = fingerprint(r.c, name, before)
            valid = valid and read_text(spark, marker) == before and all(path_exists(spark, f"{r.path(o)}/_SUCCESS") for o in outputs)
            if valid:
                continue
            delete(spark, marker)
            stage(r)
            write_text(spark, marker, before)
        return {name: r.path(name) for name in OUTPUTS}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--root", required=True, help="folder with the input Parquet tables")
    ap.add_argument("--out", help="output folder (shared storage on a cluster) for the whole pipeline")
    ap.add_argument("--query", help="run one registered query instead, e.g. auc_by_model")
    ap.add_argument("--sql", help="run one SQL statement over the tables and roles instead")
    ap.add_argument("--show", type=int, default=20, help="rows to print with --query and --sql")
    ap.add_argument("--overwrite", action="store_true")
    ap.add_argument("--resume", action="store_true", help="go on after the last finished stage of an earlier run")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    from lapse.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    if args.query or args.sql:
        from lapse.plans.queries import all_queries

        df = all_queries()[args.query](spark, args.root) if args.query else Context(spark, args.root).sql(args.sql)
        if args.out:
            write_json(df, args.out, "overwrite" if args.overwrite else "error")
        else:
            df.show(args.show, truncate=False)
        return
    if not args.out:
        ap.error("--out is required to run the pipeline")
    for name, path in run_pipeline(spark, args.root, args.out, "overwrite" if args.overwrite else "error", resume=args.resume).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
