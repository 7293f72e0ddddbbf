"""Run parameters: calendar rules, sampling, model and export settings.

Every date rule in the engine is derived from these values, so no date is
hard-coded in an operator. ``Calendar.reference()`` gives the settings of the
original 2014 competition run; ``Calendar.fixture()`` the same calendar moved
onto the driver's ``events`` table (January 2024).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# Behaviour codes of the interaction log (fixed values of the data model):
# 1 = click, 2 = skim, 3 = collect, 4 = purchase.
BEHAVIORS = (1, 2, 3, 4)
PURCHASE = 4
HOURS = tuple(range(24))


@dataclass(frozen=True)
class Calendar:
    """Label-day calendar.

    ``blackout_days`` must be contiguous; they are dropped from the log and
    shift both the training window and the lookback bounds.
    """

    end_label: dt.date
    score_day: dt.date
    blackout_days: tuple[dt.date, ...]
    slot: int = 10  # feature window, in days
    n_labels: int = 15  # label days in the training set
    lookbacks: tuple[int, ...] = (5, 3, 7)  # suffix windows, in feature order
    lookback_probe: int = 5  # the shift test is on label_day - probe, for every k

    def __post_init__(self):
        b = sorted(self.blackout_days)
        for a, c in zip(b, b[1:]):
            if (c - a).days != 1:
                raise ValueError("blackout_days must be contiguous")

    @property
    def n_blackout(self) -> int:
        return len(self.blackout_days)

    @property
    def last_blackout(self) -> dt.date | None:
        return max(self.blackout_days) if self.blackout_days else None

    @property
    def window_days_max(self) -> int:
        return self.slot + self.n_blackout

    @property
    def search_days(self) -> int:
        """How many candidate days below ``end_label`` hold ``n_labels`` valid days."""
        return self.n_labels + 2 * self.n_blackout + 2

    @property
    def spine_rows_max(self) -> int:
        """Upper bound of the (label_day, day) fan-out table: it is broadcast."""
        return (self.n_labels + 1) * (self.window_days_max + 1)

    def with_end(self, end_label: dt.date, score_day: dt.date | None = None) -> "Calendar":
        return replace(self, end_label=end_label, score_day=score_day or end_label)

    @staticmethod
    def reference() -> "Calendar":
        return Calendar(
            end_label=dt.date(2014, 12, 18),
            score_day=dt.date(2014, 12, 18),
            blackout_days=(dt.date(2014, 12, 11), dt.date(2014, 12, 12)),
        )

    @staticmethod
    def fixture() -> "Calendar":
        return Calendar(
            end_label=dt.date(2024, 1, 30),
            score_day=dt.date(2024, 1, 30),
            blackout_days=(dt.date(2024, 1, 23), dt.date(2024, 1, 24)),
        )


@dataclass(frozen=True)
class ModelParams:
    """Boosted-tree settings (MLlib ``GBTClassifier``)."""

    max_iter: int = 900
    max_depth: int = 4
    step_size: float = 0.02
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    min_instances_per_node: int = 3
    seed: int = 10
    checkpoint_interval: int = 10


@dataclass(frozen=True)
class BoostParams:
    """Second-order histogram boosting (``operators.boosting``). Fixed values of
    the original's learner: 900 rounds, depth 4, step 0.02, row and column share
    0.8, child weight 2.5, seed 10; L2 weight 1 and no least gain are the
    learner's own defaults."""

    rounds: int = 900
    depth: int = 4
    step: float = 0.02
    rows: float = 0.8  # share of rows drawn for a tree
    columns: float = 0.8  # share of columns drawn for a tree
    child_weight: float = 2.5  # least hessian of a child
    l2: float = 1.0
    min_gain: float = 1e-6
    bins: int = 256
    seed: int = 10
    checkpoint: int = 20  # rounds between stored margins


@dataclass(frozen=True)
class FeatureOptions:
    """Features that are off by default: 5- and 3-day ratios, the user hour
    grid over the last days, days between first and last touch; and whether
    distinct users per item are counted or estimated."""

    lookback_ratios: bool = False
    grid_lookbacks: tuple[int, ...] = ()
    span_days: bool = False
    approx_users: bool = False  # distinct users per item from sketches, see operators.approx

    @staticmethod
    def all() -> "FeatureOptions":
        return FeatureOptions(True, (2, 5), True)


@dataclass(frozen=True)
class HotKeys:
    """When a join splits off hot keys: at most ``max_keys`` keys, each with
    more than 1/max_keys of the rows and at least ``min_rows``."""

    max_keys: int = 10_000
    min_rows: int = 100_000


@dataclass(frozen=True)
class RunConfig:
    calendar: Calendar = field(default_factory=Calendar.reference)
    negatives_per_positive: int = 90
    sample_seed: int = 42
    top_k: int = 700
    cutoffs: tuple[int, ...] = (650, 700, 750)
    learner: str = "histogram"  # second-order boosting; "mllib": GBTClassifier
    boost: BoostParams = field(default_factory=BoostParams)
    model: ModelParams = field(default_factory=ModelParams)  # of the MLlib learner
    behaviors: tuple[int, ...] | None = None  # behaviours that make a sample pair; None: all
    aligned_score: bool = False  # scoring window as that of a training label day
    features: FeatureOptions = field(default_factory=FeatureOptions)
    hot_keys: HotKeys = field(default_factory=HotKeys)
    large_item_rows: int = 1_000_000  # an item table of more rows is too large to broadcast
    full_training_set: bool = False  # also store features for the rows that are not sampled
