from profitlens.operators.allocate import (  # noqa: F401
    LEGACY_LABELS, Level, allocate, allocate_with_fallback, pool_rollup, reallocate_single, waterfall,
    with_legacy_labels,
)
from profitlens.operators.dims import enrich, first_wins  # noqa: F401
from profitlens.operators.rollup import (  # noqa: F401
    combine, date_completeness, null_key_report, reconcile, rollup,
)
from profitlens.operators.stats import (  # noqa: F401
    group_moments, group_quantile, quantile_filter, sigma_outliers,
)
