"""rulebeam: class-rule mining for rare binary labels on Spark DataFrames.

Typical use::

    from rulebeam import PatternSpec, run_from_files, export
    run = run_from_files(spark, "train.csv", "test.csv", PatternSpec())
    run.patterns.show()          # ranked 2-4 feature patterns
    run.validated.show()         # top 10 re-measured on test, STABLE/UNSTABLE/FAILED
    export(run, "results/")      # published result tables
"""

from .functions.features import FeatureConfig, add_features, bucketize, great_circle_km
from .functions.items import items_to_predicate, parse_pattern_label, pattern_label, readable_label
from .operators.cells import build_cells, split_cells, totals
from .operators.charts import (chart_class_shares, chart_dataset_comparison, chart_pattern_types,
                               chart_rate_by_amount, chart_rate_by_time_period, chart_summary,
                               chart_top_patterns)
from .operators.domain import item_domain, top_values
from .operators.mine import extend_patterns, mine, mine_pairs, rank_all, rank_level, top_n
from .operators.profile import (compare_datasets, composition, dataset_shape, label_distribution,
                                null_profile, rate_by_feature, rate_for_feature)
from .operators.report import (confidence_drop, feature_importance, feature_matrix, pattern_counts,
                               pattern_labels, pattern_summary, pattern_type_counts, report_table,
                               run_summary, significance, summary_lines, temporal_profile, validation_long)
from .operators.label_trie import funnel_counts, trie_counts
from .operators.validate import funnel, label_report, pattern_metrics, stability, validate, validate_labels, validate_labels_on_rows
from .plans.eda import profile
from .plans.mining import MiningRun, export, run_from_files
from .plans.reporting import report
from .sources.results import check_columns, read_latest_patterns
from .sources.transactions import Holdout, event_transactions, lineitem_transactions, read_transactions
from .spec import PatternSpec, event_spec, lineitem_spec

__all__ = [name for name in dir() if not name.startswith("_")]
