"""DataFrame-in / DataFrame-out operators."""

from cityzones.operators.aggregates import first_per_key, group_avg, group_count, rmse  # noqa: F401
from cityzones.operators.filters import (  # noqa: F401
    drop_incomplete, equals, field_count_is, non_empty, not_null,
)
from cityzones.operators.generators import explode_structs, explode_values  # noqa: F401
from cityzones.operators.joins import join_measured  # noqa: F401
from cityzones.operators.partitioning import repartition_by_key  # noqa: F401
from cityzones.operators.projections import drop_columns, flatten_structs, select_renamed  # noqa: F401
from cityzones.operators.reconcile import (  # noqa: F401
    build_lookup, reconcile, reconcile_names, unmatched_keys,
)
from cityzones.operators.sets import dedupe, union_all  # noqa: F401
