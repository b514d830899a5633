"""DataFrame operators behind a mapping: select, join, delta, merge, loads, conform, recon."""

from .conform import conform_by_name, create_view, landing_projection, match_columns, positional_rename, publish_view
from .delta import build_delta, classify_columns
from .join import JoinError, apply_join
from .keys import (DuplicateKeyError, assert_unique_keys, assign_surrogate_keys, choose_merge_key, discover_keys,
                   duplicate_keys, key_profile, with_merge_key)
from .load import (load_append, load_insert_by_name, load_landing, load_merge, load_truncate,
                   load_with_surrogate_key, materialize, stage)
from .merge import align_to, merge_frames
from .ordered import asof_join, ordered_window
from .recon import reconcile, recon_counts, recon_digest, recon_empty_probe, recon_except
from .rollup import Measure, Rollup
from .select import apply_contract, build_model, model_frame
from .setops import distinct_except

__all__ = [
    "Measure", "Rollup",
    "DuplicateKeyError", "JoinError", "align_to", "asof_join", "discover_keys", "ordered_window", "recon_digest", "apply_contract", "apply_join", "assert_unique_keys",
    "assign_surrogate_keys", "build_delta", "build_model", "choose_merge_key", "classify_columns",
    "conform_by_name", "create_view", "distinct_except", "duplicate_keys", "landing_projection", "load_append",
    "load_insert_by_name", "load_landing", "load_merge", "load_truncate", "load_with_surrogate_key",
    "match_columns", "materialize", "merge_frames", "model_frame", "positional_rename", "publish_view",
    "recon_counts", "recon_empty_probe", "recon_except", "reconcile", "stage", "key_profile", "with_merge_key",
]
