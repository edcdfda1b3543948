"""quartermaster: inventory, completeness and manifest operators on Spark.

Every operator takes and returns DataFrames (or Columns) and is built from
"""

from .functions.columns import (  # P1-P8, H1
    compose_name,
    compose_version,
    default_if_empty,
    digest,
    digest_manifest,
    flags_from_type,
    glob_to_regex,
    parse_package,
    path_parts,
    replace_first,
    split_ref,
)
from .operators.aggregates import (  # A1-A5
    args_count,
    bundle_members,
    bundle_offsets,
    bundle_summary,
    collect_args,
    distinct_selection,
    nonempty_guard,
    ordinal,
    prefix_sum,
    require_nonempty,
    resolve_layers,
)
from .operators.closure import cycles, dependency_closure, dependency_order, direct_edges  # J8
from .operators.filters import (  # F1-F6
    all_present,
    allow_list,
    exclude_prefixes,
    filter_contains,
    filter_exact,
    split_valid,
    validity_counts,
)
from .operators.joins import (  # J1, J2, J4-J7
    ancestors,
    completeness,
    completeness_bitmap,
    drop_orphans,
    map_lookup,
    missing_members,
    missing_work,
    nearest_ancestor,
    orphan_rows,
    pair_merge,
    semi_join,
)
from .operators.sets import expand_all, expand_matrix, ordered_manifest, union_sets  # J3, O1, U1, U2
from .session import build_session, ensure_checkpoint_dir, scratch_dir, table
from .sinks.published import KeyIndex, publish_indexed, read_published  # K7
from .sinks.writers import (  # K1-K7
    Sink,
    fan_out,
    layout_write,
    publish_new,
    read_versioned,
    write_all,
    write_append,
    write_compressed,
    write_if_absent,
    write_replace,
    write_versioned,
)
from .sources.files import (  # S1-S5
    file_digests,
    file_inventory,
    file_inventory_all,
    glob_filter,
    glob_scan,
    inline_relation,
    layout_scan,
    line_scan,
    line_scan_numbered,
    split_lines,
)
from .streaming.streams import (  # T1, T2
    line_stream,
    read_committed,
    stream_fan_out,
    stream_fan_out_committed,
    stream_publish_indexed,
    stream_publish_new,
    table_stream,
)

__all__ = [name for name in dir() if not name.startswith("_")]
