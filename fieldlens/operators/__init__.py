from fieldlens.operators.dedup import keep_first, lookup_first, order_key
from fieldlens.operators.packing import PackedOrder, pack_order
from fieldlens.operators.children import Child, First, Measure, Text, attach_children, count_rows, reduce_children
from fieldlens.operators.antijoin import not_in, not_in_literals
from fieldlens.operators.intervals import active_as_of, label_renewals, share_label
from fieldlens.operators.collapse import collapse_text
from fieldlens.operators.rownum import global_row_number
from fieldlens.operators.rollup import level_rollup
from fieldlens.operators.joins import rank_by_mapping

__all__ = [
    "keep_first", "lookup_first", "order_key", "not_in", "not_in_literals", "active_as_of",
    "label_renewals", "share_label", "collapse_text", "global_row_number", "level_rollup",
    "rank_by_mapping", "PackedOrder", "pack_order", "Child", "First", "Measure", "Text", "attach_children", "count_rows",
    "reduce_children",
]
