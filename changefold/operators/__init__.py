from .envelope import before_after, unwrap_envelope
from .fold import apply_changes, dedup_first, fold_latest, insert_if_absent, live, op_distribution, published, set_aside
from .reconcile import (
    count_reconcile, foreign_key_orphans, key_violations, layer_counts, require_ok, table_counts, verify_layers,
)
from .rules import CUSTOMER_RULES, LOAN_RULES, TXN_RULES, Rule, RuleSet
from .secure import Mask, Policy, Principal, secured_view
from .skew import hot_keys, salted_join

__all__ = [
    "before_after", "unwrap_envelope", "apply_changes", "dedup_first", "fold_latest", "insert_if_absent", "live",
    "op_distribution", "published", "set_aside", "count_reconcile", "foreign_key_orphans", "key_violations", "layer_counts",
    "require_ok", "table_counts", "verify_layers", "CUSTOMER_RULES", "LOAN_RULES", "TXN_RULES", "Rule", "RuleSet",
    "Mask", "Policy", "Principal", "secured_view", "hot_keys", "salted_join",
]
