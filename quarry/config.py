"""Pipeline configuration.

The values in the FIXED VALUES block must equal the analysed pipeline's
settings for results to agree (keyword lists, names, thresholds, grids).
They are stated as plain text in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the analysed pipeline; do not edit to make tests pass)
# ---------------------------------------------------------------------------
RANDOM_STATE = 42
TARGET_COLUMN = "Difference"
LOW_VARIATION_THRESHOLD = 1
KEYWORDS_TO_DROP = ["photos", "details", "prop_", "_unc"]
SPECIFIC_COLUMNS_TO_DROP = [
    "completed_by", "damage_status", "ref# (DELETE LATER)", "complete_address",
    "building_name_listing", "building_name_current", "notes", "tornado_name",
    "tornado_EF", "tornado_start_lat", "tornado_start_long", "tornado_end_lat",
    "tornado_end_long", "national_register_listing_year", "town",
    "located_in_historic_district", "hazards_present_u",
]
COLUMNS_FOR_VALUE_REPLACEMENT = {
    "wall_thickness": {"un": "", "not_applicable": 0},
    "overhang_length_u": {"un": "", "not_applicable": 0},
    "parapet_height_m": {"un": "", "not_applicable": 0},
}
STRING_FILL_VALUE = "un"
TEST_SIZE = 0.2
REDUCE_CLASSES_STRATEGY = None
BALANCING_METHOD = None
PERFORM_RFE = True
N_FEATURES_TO_SELECT = 36
RFE_STEP = 0.1
CLASS_MAPPINGS = {
    "A": {0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 3},
    "B": {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 2},
}
KEYWORDS_TO_REMOVE_FROM_X = [
    "demolishing_year", "demoshed_by_2023", "buidling_use_after_tornado",
    "buidling_use_plan_after_tornado", "simulated_damage", "estimated",
    "damage", "status_u", "exist", "demolish", "failure", "after",
]
# columns the correlation / repeated-MI analysis removes besides the target
MI_CORR_EXCLUDE = ["tornado_year", "estimated", "simulated_damage"]
CLUSTERING_THRESHOLDS_TO_TEST = [None]
CLUSTERING_LINKAGE_METHOD = "average"
N_SPLITS_CV = 5
GRIDSEARCH_SCORING_METRIC = "neg_mean_squared_error"
MODEL_NAMES = [
    "Linear Regression", "Ridge", "Lasso", "ElasticNet", "SVR", "Decision Tree",
    "Random Forest", "Gradient Boosting", "Hist Gradient Boosting", "XGBoost", "LightGBM",
]
PARAM_GRIDS = {
    "Ridge": {"alpha": [0.1, 1.0, 10.0]},
    "Lasso": {"alpha": [0.1, 1.0, 10.0]},
    "ElasticNet": {"alpha": [0.1, 1.0, 10.0], "l1_ratio": [0.1, 0.5, 0.9]},
    "SVR": {"kernel": ["linear", "rbf"], "C": [0.1, 1, 10]},
    "Decision Tree": {"max_depth": [4, 6, 8], "min_samples_leaf": [10, 15]},
    "Random Forest": {"n_estimators": [100, 150], "max_depth": [6, 8], "min_samples_leaf": [5, 10]},
    "Gradient Boosting": {"n_estimators": [100], "learning_rate": [0.05, 0.1], "max_depth": [3, 4, 5]},
    "Hist Gradient Boosting": {"learning_rate": [0.05, 0.1], "max_leaf_nodes": [20, 31]},
    "XGBoost": {"n_estimators": [100], "learning_rate": [0.05, 0.1], "max_depth": [3, 4, 5]},
    "LightGBM": {"n_estimators": [100], "learning_rate": [0.05, 0.1], "num_leaves": [15, 25]},
}
N_TOP_MI = 15
N_TOP_CORR = 10
N_MI_RUNS = 100
N_TOP_MI_MEDIAN = 10
N_TOP_MODELS = 5
N_TOP_SHAP = 20
N_TOP_ORIGINAL_FEATURES = 5
RFECV_MIN_FEATURES = 10
RFECV_FOLDS = 5
MEAN_BIAS_THRESHOLD = 0.1
SKEW_THRESHOLD = 0.5
SIGNIFICANCE_ALPHA = 0.05
HISTOGRAM_BINS = 10
HUE_PALETTE_SMALL = 10
HUE_PALETTE_MEDIUM = 20
# pandas' default missing-value spellings for CSV input (public pandas documentation)
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# pandas' default boolean spellings for CSV input
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]
# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Spark-side knobs (ours, not from the analysed pipeline)
SEED_TEXT = ":42"                 # salt appended to keys for hash-based randomness
RANK_BUCKET_HEX = 5               # md5 prefix length for two-phase global ranks (16^5 buckets)
BROADCAST_ROW_LIMIT = 2_000_000   # max rows of a derived lookup table we broadcast
# other implementations of boosted trees: one Spark learner stands for the family
BOOSTING_ALIASES = ("Hist Gradient Boosting", "XGBoost", "LightGBM")
SPARK_MODEL_NAMES = [m for m in MODEL_NAMES if m not in BOOSTING_ALIASES]
QUANTILE_EXACT_LIMIT = 200_000    # rows per bracket we rank directly in exact quantiles
QUANTILE_BINS = 1024              # histogram bins per narrowing pass
MAX_CATEGORIES = 10_000           # per-column one-hot category cap (raise, never truncate)


@dataclass(frozen=True)
class PipelineConfig:
    target: str = TARGET_COLUMN
    low_variation_threshold: int = LOW_VARIATION_THRESHOLD
    keywords_to_drop: tuple = tuple(KEYWORDS_TO_DROP)
    specific_columns_to_drop: tuple = tuple(SPECIFIC_COLUMNS_TO_DROP)
    replacements: dict = field(default_factory=lambda: dict(COLUMNS_FOR_VALUE_REPLACEMENT))
    string_fill: str = STRING_FILL_VALUE
    superseded_match: str = "suffix"      # 'suffix' (cleaning) or 'anywhere' (older variant)
    drop_null_target: bool = True         # the older variant keeps and imputes the target
    impute_only_if_null: bool = True
    leakage_keywords: tuple = tuple(KEYWORDS_TO_REMOVE_FROM_X)
    test_size: float = TEST_SIZE
    seed: str = SEED_TEXT
    truncate_target: bool = True
    class_strategy: str | None = REDUCE_CLASSES_STRATEGY
    balancing: str | None = BALANCING_METHOD
    perform_rfe: bool = PERFORM_RFE
    n_features_to_select: int = N_FEATURES_TO_SELECT
    rfe_step: float = RFE_STEP
    thresholds: tuple = tuple(CLUSTERING_THRESHOLDS_TO_TEST)
    n_folds: int = N_SPLITS_CV
    models: tuple = tuple(SPARK_MODEL_NAMES)
    row_id: str = "row_id"
