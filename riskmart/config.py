"""Configuration: one frozen dataclass for parameters, one for table locations."""

from __future__ import annotations

from dataclasses import dataclass, field

# Literals that appear in result rows or decide which rows a result holds.
NO_DATA = "(sin dato)"
MISSING_LEVEL = "missing"
OTHER_LEVEL = "other"
UNKNOWN_BRAND = "otro"
SENTINEL = -999
SPLIT_TRAIN = "entrenamiento"
SPLIT_VALIDATION = "validacion"
SPLIT_HOLDOUT = "test_kaggle"
DATASET_TRAIN = "train"
DATASET_TEST = "test"
AUDIT_COLUMNS = ("_ingest_ts", "_source_file")
SECONDS_PER_DAY = 86_400
SECONDS_PER_HOUR = 3_600


def threshold_grid(steps: int = 20) -> list[float]:
    """Open grid (0, 1) with ``steps`` intervals: 20 gives 0.05, 0.10 … 0.95."""
    return [k / float(steps) for k in range(1, steps)]


@dataclass(frozen=True)
class RiskConfig:
    """Every tunable of the batch stages, the model and the stream."""

    # source columns
    key: str = "TransactionID"
    label: str = "isFraud"
    amount: str = "TransactionAmt"
    seconds: str = "TransactionDT"
    email_columns: tuple[tuple[str, str], ...] = (
        ("P_emaildomain", "P_email_provider"),
        ("R_emaildomain", "R_email_provider"),
    )
    device_text: str = "DeviceInfo"
    device_brand: str = "device_brand"
    rare_column: str = "card6"
    rare_keep: tuple[str, ...] = ("credit", "debit")
    presence: str = "has_identity"
    protected: tuple[str, ...] = (
        "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "dataset",
    )
    segments: tuple[str, ...] = (
        "ProductCD", "card4", "card6", "P_email_provider", "DeviceType", "device_brand", "hour", "weekday",
    )
    cube_dims: tuple[str, ...] = ("ProductCD", "card6", "DeviceType", "P_email_provider")
    business: tuple[str, ...] = (
        "ProductCD", "card4", "card6", "P_email_provider", "DeviceType", "device_brand",
    )
    not_features: tuple[str, ...] = (
        "TransactionID", "isFraud", "TransactionDT", "day", "dataset",
        "P_emaildomain", "R_emaildomain", "DeviceInfo",
    )
    # thresholds and windows
    max_null_fraction: float = 0.90
    min_support: int = 100
    max_categories: int = 60
    validation_days: int = 30
    cardinality_on_training_only: bool = True
    #: name under which this loader claims files, where several may run at once; None: it is the only one
    loader: str | None = None
    # model
    max_bins: int = 64
    trees: int = 60
    tree_depth: int = 5
    step_size: float = 0.1
    subsampling: float = 0.8
    seed: int = 42
    negative_fraction: float = 1.0
    with_baseline: bool = True
    baseline_iterations: int = 30
    baseline_reg: float = 0.01
    min_roc_auc: float = 0.85
    min_recall: float = 0.70
    # threshold economics
    thresholds: tuple[float, ...] = field(default_factory=lambda: tuple(threshold_grid()))
    review_cost: float = 5.0
    chargeback_cost: float = 25.0
    # stream
    trigger: str = "2 seconds"
    replay_day: int | None = None
    replay_pause_s: float = 2.0
    #: a message whose key came within this time before is not scored again; None: no check
    repeat_within: str | None = "1 hour"
    keep_alerts: bool = False

    def __post_init__(self) -> None:
        # the "missing" level and the unseen bucket are two extra categories per indexed column
        if self.max_categories + 2 > self.max_bins:
            raise ValueError(
                f"max_categories + 2 must not exceed max_bins ({self.max_categories} + 2 > {self.max_bins})"
            )
        if not 0.0 < self.negative_fraction <= 1.0:
            raise ValueError("negative_fraction must lie in (0, 1]")


@dataclass(frozen=True)
class Layout:
    """Where the tables of each layer live, and in which format.

    With ``buckets`` the bronze tables are bucketed by the key, so that cleaning them needs no shuffle (parquet only).
    """

    root: str
    fmt: str = "parquet"
    buckets: int | None = None

    def __post_init__(self) -> None:
        if self.buckets is not None and (self.buckets < 1 or self.fmt != "parquet"):
            raise ValueError("bucketed tables are parquet and have at least one bucket")

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def bronze(self, name: str) -> str:
        return self.table("bronze", name)

    def silver(self, name: str) -> str:
        return self.table("silver", name)

    def gold(self, name: str) -> str:
        return self.table("gold", name)

    def meta(self, name: str) -> str:
        return self.table("_meta", name)

    def staging(self, name: str) -> str:
        """Intermediate tables."""
        return self.table("_staging", name)

    def model(self, name: str) -> str:
        return self.table("models", name)
