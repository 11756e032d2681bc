"""Column names and default parameters of the demand workload.

Operators take every name as an argument; these are only the defaults the plans
pass in.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from fractions import Fraction

# Layer column names, model inputs, thresholds and aliases.
TIME = "transaction_date"
SERIES = ("product_name", "destination_city")
SOURCE_KEY = "transaction_id"
KEY = "primary_key"
TARGET = "total_demand"
METADATA = ("ingestion_timestamp", "source_system", "operation_type")
LAGS = {1: "demand_1", 7: "demand_7"}
ROLLING_ROWS = 7
ROLLING = "rolling_7_day_avg"
CATEGORICAL = ("product_name", "destination_city")
NUMERIC = (
    "avg_unit_price",
    "total_inventory",
    "transaction_count",
    "demand_1",
    "demand_7",
    "rolling_7_day_avg",
    "month",
    "day_of_week",
)
COLD_START = ("demand_1", "demand_7", "rolling_7_day_avg")
FEATURES = (
    "primary_key",
    "transaction_date",
    "product_name",
    "destination_city",
    "avg_unit_price",
    "total_inventory",
    "transaction_count",
    "demand_1",
    "demand_7",
    "rolling_7_day_avg",
    "month",
    "day_of_week",
)
LABELS = ("primary_key", "total_demand")
MEASURES = (
    ("total_demand", "sum", "demand_quantity"),
    ("avg_unit_price", "mean", "unit_price_usd"),
    ("total_inventory", "sum", "available_inventory"),
    ("transaction_count", "count", None),
)
# Feed columns that reach the facts.
USED = (
    "transaction_date",
    "product_name",
    "destination_city",
    "demand_quantity",
    "unit_price_usd",
    "available_inventory",
)
CHAMPION = "Champion"
CHALLENGER = "Challenger"
TEST_R2_THRESHOLD = 0.90
HELD_OUT = Fraction(1, 5)
SELECTION_METRIC = "validation_r2"
RUN_NAME = "decision_tree"
MODEL_NAME = "demand_forecast"
# Tags of a registered version.
TAG_TEST_R2 = "test_r2"
TAG_STATUS = "test_r2_status"
TAG_CLEARED = "cleared"
TAG_PASSED = "metric_r2_passed"
TAG_CHAMPION = "champion_r2"


@dataclass(frozen=True)
class TreeSpec:
    """Regression-tree parameters.

    ``min_leaf`` also bounds the smallest splittable node: a split that leaves
    at least 15 rows on both sides needs 30 rows to begin with.
    ``max_bins`` is the number of candidate thresholds per numeric column.
    """

    max_depth: int = 15
    min_leaf: int = 15
    max_bins: int = 128
    seed: int = 42

    def as_params(self) -> dict[str, str]:
        """Every field by its own name: what it takes to fit the model again."""
        return {name: str(value) for name, value in asdict(self).items()}


@dataclass(frozen=True)
class Tables:
    """Where each layer lives: a catalog table name or a path per layer."""

    bronze: str
    silver: str
    gold: str
    gold_features: str
    features: str
    labels: str
    predictions: str
    models: str

    @classmethod
    def under(cls, root: str) -> "Tables":
        root = root.rstrip("/")
        return cls(
            bronze=f"{root}/bronze",
            silver=f"{root}/silver",
            gold=f"{root}/gold",
            gold_features=f"{root}/gold_features",
            features=f"{root}/features",
            labels=f"{root}/labels",
            predictions=f"{root}/predictions",
            models=f"{root}/models",
        )


    @classmethod
    def in_database(cls, database: str) -> "Tables":
        """Catalog tables of one database, named after their layers."""
        return cls(**{name: f"{database}.{name}" for name in cls.__dataclass_fields__})


@dataclass(frozen=True)
class Lifecycle:
    """Names and thresholds of the model lifecycle."""

    model_name: str = MODEL_NAME
    run_name: str = RUN_NAME
    metric: str = SELECTION_METRIC
    threshold: float = TEST_R2_THRESHOLD
    champion: str = CHAMPION
    challenger: str = CHALLENGER
    tags: dict[str, str] = field(default_factory=dict)
