"""Lazily built role views and shared intermediate frames for one data root."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lapse.config import DEFAULT, Params
from lapse.operators import features as feat
from lapse.operators import modeltable as mt
from lapse.operators import calibrate as cb
from lapse.operators import decide as dc
from lapse.operators import learn as lr
from lapse.operators import metrics as me
from lapse.operators.scoring import SCORERS, closed_form_predictions
from pyspark.sql import functions as F
from lapse.operators.ranking import DEFAULT_PLAN, RankPlan
from lapse.sources import roles
from lapse.sources.ingest import pick_source
from lapse.sources.sinks import Manifest
from lapse.sources.store import materialize
from lapse.sources.tables import Reader, read_table, register_views


class Context:
    def __init__(self, spark: SparkSession, root: str, params: Params = DEFAULT, plan: RankPlan = DEFAULT_PLAN,
                 read: Reader = read_table):
        self.spark = spark
        self.root = root
        self.p = params
        self.plan = plan
        self.read = read

    @property
    def w(self):
        return self.p.windows

    def sql(self, statement: str) -> DataFrame:
        """A Spark SQL statement over the tables of the root and the roles ``members``, ``label``,
        ``transactions`` and ``user_logs``.  Schemas are declared, so no job is run before the statement's own; it is
        resolved here, and views that another context registers later do not change it."""
        register_views(self.spark, self.root)
        for name, role in (("members", self.members), ("label", self.label), ("transactions", self.txns), ("user_logs", self.logs)):
            role.createOrReplaceTempView(name)
        return self.spark.sql(statement)

    @cached_property
    def members(self) -> DataFrame:
        return roles.members(self.spark, self.root, read=self.read)

    @cached_property
    def label(self) -> DataFrame:
        return roles.labels(self.spark, self.root, read=self.read)

    @cached_property
    def txns(self) -> DataFrame:
        return roles.transactions(self.spark, self.root, read=self.read)

    @cached_property
    def logs(self) -> DataFrame:
        """Activity logs from the preferred source that exists (later snapshots first)."""
        return roles.logs(self.spark, self.root, pick_source(self.spark, self.root, roles.LOG_SOURCES), read=self.read)

    @cached_property
    def base(self) -> DataFrame:
        return feat.user_base_table(self.label, self.members, self.txns, self.logs, self.w)

    @cached_property
    def features(self) -> DataFrame:
        return feat.derived_features(self.base, self.w)

    @cached_property
    def split(self) -> DataFrame:
        """user_key, is_churn, split — computed on the narrow label view."""
        return mt.stratified_split(
            self.label, seed=self.p.seed, holdout_pct=self.p.holdout_pct,
            test_pct_of_holdout=self.p.test_pct_of_holdout, plan=self.plan,
        )

    @cached_property
    def split_features(self) -> DataFrame:
        """Features with their split, written once to the checkpoint folder: every fit
        (medians, codes, scaler) and every split reads it back, partition-pruned."""
        return materialize(mt.attach_split(self.features, self.split), "split_features", "split")

    @cached_property
    def builder(self) -> mt.ModelTableBuilder:
        return mt.ModelTableBuilder(self.split_features, plan=self.plan)

    @cached_property
    def model_table(self) -> DataFrame:
        """Written once: profile, learners and writers read it back."""
        return materialize(self.builder.model_table(), "model_table", "split")

    @cached_property
    def predictions(self) -> DataFrame:
        """Closed-form scores for every (model, user) over the materialised feature table."""
        return closed_form_predictions(self.split_features)

    @cached_property
    def metrics(self) -> DataFrame:
        """Every metric per (model, split), written once: comparison and frontier read it several times."""
        return materialize(me.model_metrics(self.predictions, plan=self.plan), "model_metrics")

    def model_split(self, model_id: str, split: str) -> DataFrame:
        """Predictions of one model on one split: scores only that model, reads only that
        split's partition of the materialised feature table."""
        part = self.split_features.filter(F.col("split") == split)
        return closed_form_predictions(part, {model_id: SCORERS[model_id]})

    @cached_property
    def manifest(self) -> DataFrame:
        """The feature manifest with windows and numeric columns, as it is written."""
        return materialize(mt.full_manifest(self.builder.category_map(), self.w), "feature_manifest")

    @cached_property
    def learners(self) -> lr.Learners:
        return lr.Learners(self.model_table, Manifest.of(self.manifest).check(self.w), self.p.seed)

    @cached_property
    def learned_heads(self) -> DataFrame:
        """Predictions of every learned head and the joined model, written once."""
        return materialize(lr.all_heads(self.learners), "learned_heads", "split")

    @cached_property
    def learned(self) -> DataFrame:
        """Prediction table of the learned model with both heads, written once."""
        return materialize(self.learners.joint(), "learned_predictions", "split")

    @cached_property
    def learned_calibrated(self) -> DataFrame:
        """Learned test scores, isotonically calibrated on validation."""
        iso = cb.isotonic_fit(self.learned.filter(F.col("split") == "val"))
        return materialize(cb.isotonic_apply(iso, self.learned.filter(F.col("split") == "test")), "learned_calibrated")

    @cached_property
    def learned_ranked(self) -> DataFrame:
        return materialize(dc.priority_scores(self.learned_calibrated, plan=self.plan), "learned_priority")

    @cached_property
    def isotonic(self):
        """Isotonic calibrator of the joint model, fitted on validation."""
        return cb.isotonic_fit(self.model_split("joint", "val"))

    @cached_property
    def calibrated_test(self) -> DataFrame:
        return cb.isotonic_apply(self.isotonic, self.model_split("joint", "test"))

    @cached_property
    def ranked(self) -> DataFrame:
        """Retention priority table of the test users, written once (it is also a deliverable)."""
        return materialize(dc.priority_scores(self.calibrated_test, plan=self.plan), "priority_scores")

    @cached_property
    def ranked_raw(self) -> DataFrame:
        """Priority table on the uncalibrated scores, whose range reaches the clip of the sensitivity."""
        return materialize(dc.priority_scores(self.model_split("joint", "test"), prob="score", plan=self.plan), "priority_raw")

    @cached_property
    def rank_changes(self) -> DataFrame:
        """Rank changes of the picked users, written once: the summary and the histogram read them several times."""
        return materialize(dc.rank_changes(self.ranked_raw, self.p.budget.n_interventions, self.p.sensitivity_pct, plan=self.plan), "rank_changes")
