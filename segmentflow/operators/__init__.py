"""DataFrame operators.  Each function takes and returns DataFrames (or
Columns) and adds no Python code to the plan."""

from segmentflow.operators.dedup import deduplicate, latest_per_key  # noqa: F401
from segmentflow.operators.diff import definition_diff  # noqa: F401
from segmentflow.operators.marts import (  # noqa: F401
    active_segments,
    ingest_status,
    main_table,
    orders_daily,
    orders_raw,
    segment_fanout,
    sum_by_group,
)
from segmentflow.operators.merge import (  # noqa: F401
    membership_closed_form,
    segment_activate,
    segment_deactivate,
    segment_membership,
    upsert_keep_non_null,
    upsert_replay,
)
from segmentflow.operators.overlap import (  # noqa: F401
    all_pairs,
    duplicate_rate,
    overlap_stats,
    overlap_summary,
    pair_overlap,
    pair_overlap_stats,
    seen_before,
    shared_at_least,
    unseen_keys,
)
from segmentflow.operators.profile import count_by, file_inventory, inventory_totals, null_profile  # noqa: F401
from segmentflow.operators.quality import check_report, not_null, unique_key, valid_rows  # noqa: F401
from segmentflow.operators.scd2 import current_rows, scd2_fold, scd2_merge  # noqa: F401
from segmentflow.operators.surrogate import assign_new_ids, fix_collisions, hash_id  # noqa: F401
