from gildhall.operators.audit import audit_event, gate, run_outcome, run_state
from gildhall.operators.cdc import (
    affected_grains, change_window, changed_keys, freshness, high_water, high_waters, is_fresh, reaggregate,
)
from gildhall.operators.dedup import keep_one, latest_flag, latest_snapshot
from gildhall.operators.joins import (
    cast_join, const_lookup, decode, first_hit, net_new, not_in_guarded, period_contains, pick_one,
    poly_ref, preagg_join, prefix_join, resolve_sk, semi, unique_on, valid_rows,
)
from gildhall.operators.quality import profile, quality_suite
from gildhall.operators.scd import key_bucket, scd2_apply, scd2_asof, scd2_classify, scd2_initial, scd2_screen, scd2_stats
from gildhall.operators.sequence import (
    assign_sk, delta, exact_percentile, merged_sketches, ordinal, quantile_sketches, rank_by_agg, sketch_percentiles,
)
from gildhall.operators.shapes import avg_of_counts, distinct_union, id_list, subtype_union, union_shapes
from gildhall.operators.snapshots import SnapshotFact, row_digest, unseen
from gildhall.operators.tree import org_checks, org_paths

__all__ = [
    "audit_event", "gate", "run_outcome", "run_state",
    "affected_grains", "change_window", "changed_keys", "freshness", "high_water", "high_waters", "is_fresh",
    "reaggregate",
    "keep_one", "latest_flag", "latest_snapshot",
    "cast_join", "const_lookup", "decode", "first_hit", "net_new", "not_in_guarded", "period_contains",
    "pick_one", "poly_ref", "preagg_join", "prefix_join", "resolve_sk", "semi", "unique_on", "valid_rows",
    "profile", "quality_suite",
    "key_bucket", "scd2_apply", "scd2_asof", "scd2_classify", "scd2_initial", "scd2_screen", "scd2_stats",
    "assign_sk", "delta", "exact_percentile", "merged_sketches", "ordinal", "quantile_sketches",
    "rank_by_agg", "sketch_percentiles",
    "avg_of_counts", "distinct_union", "id_list", "subtype_union", "union_shapes",
    "org_checks", "org_paths", "SnapshotFact", "row_digest", "unseen",
]
