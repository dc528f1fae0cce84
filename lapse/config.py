"""Frozen parameters: time windows, seeds, split shares, budget policy."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Windows:
    """Time windows of the feature table.

    Features may only see rows on or before ``feature_cutoff``; the value target sums
    revenue in the closed window ``[value_start, value_end]``; engagement counts activity
    in ``[engagement_start, engagement_end]``.  The defaults bind the windows to the
    driver tables (orders end in 2001; the clock of the events is shifted, see ``roles``).
    """

    feature_cutoff: dt.date = dt.date(2000, 12, 31)
    value_start: dt.date = dt.date(2001, 1, 1)
    value_end: dt.date = dt.date(2001, 2, 28)
    engagement_start: dt.date = dt.date(2000, 12, 17)
    engagement_end: dt.date = dt.date(2000, 12, 31)


@dataclass(frozen=True)
class Budget:
    """Retention budget policy: ``budget // voucher`` users get a voucher that saves
    ``success_rate`` of their priority score."""

    budget: int = 50_000
    voucher: int = 50
    success_rate: float = 0.30

    @property
    def n_interventions(self) -> int:
        return self.budget // self.voucher


@dataclass(frozen=True)
class Params:
    windows: Windows = field(default_factory=Windows)
    budget: Budget = field(default_factory=Budget)
    scatter_rows: int = 20_000
    seed: int = 42
    # Split shares in percent: hold-out share of each stratum, then test share of the hold-out.
    holdout_pct: int = 30
    test_pct_of_holdout: int = 50
    # Exclusive sensitivity perturbation of P(churn), in percent.
    sensitivity_pct: int = 10
    n_reliability_bins: int = 10
    n_hist_bins: int = 50
    top_channels: int = 8
    # Plausible registration years; bound to the driver tables (registrations span 1990-2000).
    reg_year_range: tuple[int, int] = (1990, 2000)


DEFAULT = Params()
# The registered queries run on tables of a few hundred test users, where 1,000 vouchers or a sample of 20,000 rows
# would take everybody and no policy could differ from another: their checks use a smaller plan.
CHECKED = Params(budget=Budget(budget=2_000), scatter_rows=100)
