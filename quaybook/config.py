"""Configuration for the booking operators.

Every operator takes column names and thresholds from :class:`BookingConfig`,
so the same code runs on any flat table once the names are given. The
module-level tuples below are the fixed values of the booking data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original pipeline's values for the same
# results; they are stated plainly and kept together on purpose.
# ---------------------------------------------------------------------------

# English month names, January first.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
# Days per month in the reference year 2024 (a leap year), January first.
DAYS_IN_MONTH = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
REFERENCE_YEAR = 2024
DAYS_IN_REFERENCE_YEAR = 366
MONTHS_PER_YEAR = 12

# Raw booking columns in their required order.
BOOKING_COLUMNS = (
    "booking_id", "no_show", "branch", "booking_month", "arrival_month",
    "arrival_day", "checkout_month", "checkout_day", "country", "first_time",
    "room", "price", "platform", "num_adults", "num_children",
)
# Columns parsed to 64-bit integers by cleaning, and typed int64 by the checks.
INTEGER_COLUMNS = (
    "booking_id", "no_show", "arrival_day", "checkout_day", "num_adults",
    "num_children",
)
STRING_COLUMNS = (
    "branch", "booking_month", "arrival_month", "checkout_month", "country",
    "first_time", "room", "price", "platform",
)

MISSING_DROP_THRESHOLD = 0.05
ADULT_COUNT_WORDS = {"one": "1", "two": "2"}

TARGET_VALUES = (0.0, 1.0)
BRANCHES = ("Changi", "Orchard")
COUNTRIES = (
    "Australia", "China", "India", "Indonesia", "Japan", "Malaysia",
    "Singapore",
)
FIRST_TIME_VALUES = ("Yes", "No")
ROOMS = ("Single", "Queen", "King", "President Suite")
PLATFORMS = ("Website", "Email", "Agent", "Phone")
GUEST_COUNT_RANGE = (0, 5)

# Price text: strict form for the quality check, lax form for parsing.
PRICE_CHECK_REGEX = r"^(?:SGD|USD)\$\s*\d+(?:\.\d+)?$"
PRICE_PARSE_REGEX = r"^\s*(SGD|USD)\$\s*(\d+(?:\.\d+)?)\s*$"
USD_TO_SGD = 1.35

# Model inputs.
NUMERIC_FEATURES = (
    "arrival_day", "checkout_day", "num_adults", "num_children",
    "price_amount_sgd", "stay_length_nights", "booking_to_arrival_month_gap",
    "total_guests", "price_per_guest", "price_per_night",
    "price_per_guest_per_night",
)
CATEGORICAL_FEATURES = (
    "branch", "booking_month", "arrival_month", "checkout_month", "country",
    "first_time", "room", "platform", "price_currency",
)
MISSING_CATEGORY = "missing"

# Experiment settings.
SEED = 42
TEST_SIZE = 0.2
CV_FOLDS = 5
CALIBRATION_FOLDS = 5
CALIBRATION_METHOD = "isotonic"
SCORING = "roc_auc"
EXPERIMENT_NAME = "no_show"

# Search grids, one per model family, in the order of the candidate list.
RANDOM_FOREST_GRID = {
    "n_estimators": (100, 200),
    "max_depth": (None, 16),
    "min_samples_leaf": (1, 5, 10, 20),
    "max_features": ("sqrt", "log2"),
}
LEAF_WISE_BOOSTING_GRID = {
    "n_estimators": (100, 300),
    "learning_rate": (0.05, 0.1),
    "num_leaves": (15, 31, 63, 127),
    "min_child_samples": (20, 50),
}
DEPTH_WISE_BOOSTING_GRID = {
    "n_estimators": (100, 300),
    "learning_rate": (0.05, 0.1, 0.2, 0.3),
    "max_depth": (3, 6),
    "min_child_weight": (1, 5),
}

# Report settings.
GUIDE_RATE = 0.60
CALIBRATION_BINS = 25
MAX_RUNS_TO_CHECK = 50
MAX_EXAMPLES = 20
TARGET_LABELS = ("Show", "No-show")
LOG_LOSS_EPS = 2.220446049250313e-16  # float64 machine epsilon

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class BookingConfig:
    """Column names and thresholds used by the operators."""

    id_col: str = "booking_id"
    target_col: str = "no_show"
    price_col: str = "price"
    adults_col: str = "num_adults"
    children_col: str = "num_children"
    booking_month_col: str = "booking_month"
    arrival_month_col: str = "arrival_month"
    arrival_day_col: str = "arrival_day"
    checkout_month_col: str = "checkout_month"
    checkout_day_col: str = "checkout_day"
    integer_cols: tuple[str, ...] = INTEGER_COLUMNS
    missing_drop_threshold: float = MISSING_DROP_THRESHOLD
    adult_words: dict = field(default_factory=lambda: dict(ADULT_COUNT_WORDS))
    usd_to_sgd: float = USD_TO_SGD
    seed: int = SEED
    test_size: float = TEST_SIZE
    cv_folds: int = CV_FOLDS
    numeric_features: tuple[str, ...] = NUMERIC_FEATURES
    categorical_features: tuple[str, ...] = CATEGORICAL_FEATURES


DEFAULT = BookingConfig()
