from reelframe.operators.aggregates import (
    count_by,
    exploded,
    exploded_counts,
    frequent,
    largest_first,
    nonzero_counts,
    runtime_histogram,
    share_labels,
    share_of_total,
    top_counts,
)
from reelframe.operators.cells import (
    cell_listing,
    cells_to_wide,
    latest_cells,
    latest_rows,
    upsert_cells,
    wide_to_cells,
)
from reelframe.operators.joins import keyed_cross_join, positional_zip
from reelframe.operators.ranking import (
    Descending,
    descending,
    fixed_slots,
    row_index,
    sort_desc,
    sorting,
    top_k,
    unique_id,
)
from reelframe.operators.regression import (
    assemble_features,
    coefficients,
    fit_metrics,
    fit_scores,
    linear_score,
    model_inputs,
    model_params,
    residuals,
    score_fill,
    score_predict,
)
from reelframe.operators.rows import (
    cast_floats,
    drop_nulls,
    label_split,
    nonblank_rows,
    nonzero_rows,
    preview,
    project_columns,
    round_project,
    union_all,
)

__all__ = [name for name in dir() if not name.startswith("_")]
