"""Parameters of feature derivation and pattern mining.

Everything the mining operators need to know about the data lives here,
not in operator code: the feature list, the label, per-level value
domains, thresholds, beam width and validation tolerances.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Mapping, Sequence

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published analysis for results to
# match; they are stated here once, in natural order.
# ---------------------------------------------------------------------------

# Mining features, in generation order (order decides tie-breaks).
MINING_FEATURES = (
    "category", "time_period", "amt_category", "age_group",
    "distance_category", "gender", "is_weekend", "day_of_week",
)
# Profiling features (no day_of_week).
PROFILE_FEATURES = (
    "category", "gender", "time_period", "amt_category",
    "age_group", "distance_category", "is_weekend",
)

# Bucket edges: value < edge[i] -> label[i], otherwise the last label.
AMOUNT_EDGES = (10, 50, 200, 500)
AMOUNT_LABELS = ("very_low", "low", "medium", "high", "very_high")
AGE_EDGES = (25, 35, 50, 65)
AGE_LABELS = ("young", "young_adult", "middle_aged", "older_adult", "senior")
DISTANCE_EDGES = (5, 25, 100, 500)
DISTANCE_LABELS = ("very_close", "close", "medium_distance", "far", "very_far")
# Inclusive hour ranges; every other hour (and a null hour) is "night".
TIME_PERIODS = (("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 21))
TIME_PERIOD_OTHERWISE = "night"
EARTH_RADIUS_KM = 6371
DAYS_PER_YEAR = 365
WEEKEND_DAYS = (1, 7)  # dayofweek(): 1 = Sunday, 7 = Saturday

# Display order of amount buckets in the ordered rate chart.
AMOUNT_ORDER = ("very_low", "low", "medium", "high", "very_high")

# Fixed value domains per level (card data). Other features use top-k.
CARD_DOMAINS = {
    2: {
        "amt_category": ("very_high", "high", "medium", "low"),
        "time_period": ("night", "afternoon", "morning", "evening"),
        "category": ("shopping_net", "misc_net", "grocery_pos", "shopping_pos", "gas_transport"),
    },
    3: {
        "amt_category": ("very_high", "high", "medium"),
        "time_period": ("night", "afternoon", "morning", "evening"),
        "category": ("shopping_net", "misc_net", "grocery_pos"),
    },
}
# Same shape for the event-table binding: its categories are event types.
EVENT_DOMAINS = {
    2: {
        "amt_category": ("very_high", "high", "medium", "low"),
        "time_period": ("night", "afternoon", "morning", "evening"),
        "category": ("purchase", "error", "view", "click", "signup"),
    },
    3: {
        "amt_category": ("very_high", "high", "medium"),
        "time_period": ("night", "afternoon", "morning", "evening"),
        "category": ("purchase", "error", "view"),
    },
}

MIN_SUPPORT = {2: 0.0005, 3: 0.0002, 4: 0.0002}
# Ranked (non-fixed) features keep max(TOP_K_MIN, TOP_K_BASE - level) values.
TOP_K_BASE = 5
TOP_K_MIN = 2
MIN_CONFIDENCE = {2: 0.02}
BEAM = 15
TOP_N = 15
VALIDATE_N = 10
# Stability: all absolute train/test differences strictly below these.
STABLE_SUPPORT_DIFF = 0.002
STABLE_CONFIDENCE_DIFF = 0.05
STABLE_LIFT_DIFF = 10.0
# Label text: items joined by " AND ", feature and value by "=".
ITEM_SEP = " AND "
KV_SEP = "="
# Inside a feature or value: the escape sign goes before itself, before the word AND (between spaces or at an
# end), before a space at either end, and, in a feature, before "=".
ESCAPE = "\\"
# Readable label: " AND " -> " & ", "=" -> ": ", cut to 77 + "..." over 80.
READABLE_ITEM_SEP = " & "
READABLE_KV_SEP = ": "
READABLE_WIDTH = 80
READABLE_KEEP = 77
REPORT_NAME_WIDTH = 58
SUMMARY_NAME_WIDTH = 60
SUMMARY_TOP = 5
# README promise, off unless asked for.
DOCUMENTED_MIN_LIFT = 5.0

# Output formats: result-table columns, summary metrics, status and reason
# texts, the run stamp and the text summary.
PATTERN_TYPE_SUFFIX = "-Feature"
PATTERN_EXPORT_COLUMNS = ("Rank", "Pattern_Type", "Pattern_Name", "Support", "Confidence", "Lift", "Score",
                          "Pattern_Total_Transactions", "Pattern_Fraud_Transactions", "Fraud_Rate_Percent")
VALIDATION_EXPORT_COLUMNS = ("Pattern_ID", "Pattern_Name", "Train_Confidence", "Test_Confidence", "Train_Lift",
                             "Test_Lift", "Confidence_Diff", "Lift_Diff", "Status", "Valid")
# A reloaded table is pattern data when it has any of these columns.
PATTERN_TABLE_MARKERS = ("Pattern_Name", "Confidence", "Test_Confidence", "Train_Confidence", "Fraud_Rate_Percent")
SUMMARY_METRICS = ("Total_Training_Transactions", "Total_Test_Transactions", "Training_Fraud_Rate_Percent",
                   "Total_Patterns_Discovered", "Patterns_Validated", "Stable_Patterns",
                   "Best_Pattern_Confidence_Percent", "Best_Pattern_Lift", "Analysis_Timestamp")
STATUS_STABLE, STATUS_UNSTABLE, STATUS_FAILED = "STABLE", "UNSTABLE", "FAILED"
VALID_YES, VALID_NO, NOT_AVAILABLE = "Yes", "No", "N/A"
REASON_NO_MATCH = "No matching transactions"
REASON_BAD_PART = "Invalid pattern part: "
REASON_FILTER_ERROR = "Filter error on condition "
REASON_NULL_LABEL = "No pattern label"
# Result tables as CSV: quotes are doubled, so a backslash in a value stands for itself.
CSV_TEXT = {"header": True, "escape": '"'}
REJECT_FIELDS = "Wrong number of fields"
REJECT_VALUE = "Malformed "
RUN_STAMP_FORMAT = "%Y%m%d_%H%M%S"
SUMMARY_HEADER = "FRAUD PATTERN ANALYSIS SUMMARY"
SUMMARY_GENERATED = "Generated: {}"
SUMMARY_DATASET = "DATASET INFORMATION:"
SUMMARY_COUNT = "- Total patterns analyzed: "
SUMMARY_SOURCE = "- Data source: {}"
SUMMARY_TOP_TITLE = "TOP 5 PATTERNS:"
SUMMARY_PATTERN_LINE = "%d. %s..."
SUMMARY_RATE_LINE = "   Fraud Rate: %.1f%%"


@dataclass(frozen=True)
class PatternSpec:
    """What to mine and how.

    ``domains[level][feature]`` fixes the candidate values of a feature at a
    level; features without a fixed list take their ``top_k(level)`` most
    frequent values (count desc, value asc; a null takes a slot and is then
    dropped). Levels above 3 reuse the level-3 domain.
    """

    features: tuple[str, ...] = MINING_FEATURES
    label: str = "is_fraud"
    positive: int = 1
    negative: int = 0
    domains: Mapping[int, Mapping[str, Sequence[str]]] = field(default_factory=lambda: CARD_DOMAINS)
    min_support: Mapping[int, float] = field(default_factory=lambda: dict(MIN_SUPPORT))
    min_confidence: Mapping[int, float] = field(default_factory=lambda: dict(MIN_CONFIDENCE))
    min_lift: float | None = None
    beam: int = BEAM
    max_len: int = 4
    top_n: int = TOP_N
    validate_n: int = VALIDATE_N
    dedupe: bool = False
    tolerances: tuple[float, float, float] = (
        STABLE_SUPPORT_DIFF, STABLE_CONFIDENCE_DIFF, STABLE_LIFT_DIFF)
    # Values per ranked feature at a domain level: max(top_k_min, top_k_base - level).
    top_k_base: int = TOP_K_BASE
    top_k_min: int = TOP_K_MIN

    @staticmethod
    def domain_level(level: int) -> int:
        """Extension levels all draw candidates from the level-3 domain."""
        return 2 if level <= 2 else 3

    def top_k(self, level: int) -> int:
        return max(self.top_k_min, self.top_k_base - level)

    def fixed_domain(self, level: int) -> Mapping[str, Sequence[str]]:
        return self.domains.get(self.domain_level(level), {})

    def with_(self, **kw) -> "PatternSpec":
        return replace(self, **kw)


# Binding with a wide feature (birth date: about one value per customer).
WIDE_FEATURES = ("category", "time_period", "amt_category", "distance_category", "gender", "dob")

# Order-line binding (lineitem x orders x customer x part): our own bands.
LINEITEM_FEATURES = (
    "order_priority", "segment", "part_class", "line_status",
    "order_status", "quantity_band", "price_band", "discount_band",
)
QUANTITY_EDGES = (10, 25, 40)
QUANTITY_LABELS = ("small", "medium", "large", "bulk")
PRICE_EDGES = (25000, 50000, 75000)
PRICE_LABELS = ("low", "mid", "high", "top")
DISCOUNT_EDGES = (0.03, 0.07)
DISCOUNT_LABELS = ("low", "mid", "high")
RETURNED_FLAG = "R"


def lineitem_spec(**kw) -> PatternSpec:
    """Spec for the order-line view: every feature takes its top-k values."""
    return PatternSpec(features=LINEITEM_FEATURES, label="is_returned", domains={}, **kw)


def event_spec(**kw) -> PatternSpec:
    """Spec for the transaction view over the ``events`` table."""
    return PatternSpec(domains=EVENT_DOMAINS, **kw)
