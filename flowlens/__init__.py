"""flowlens: Spark-native funnel, growth and path analytics.

Every operator is a function from DataFrames to a lazy DataFrame built from
native Spark expressions, aggregations, joins and windows.  Sub-packages:

* ``functions``  - shared column expressions and skew-safe building blocks: LAG/LEAD, ranks,
                   running sums, percentiles, distinct counts that roll up, interval joins
* ``sources``    - table readers, the publish sink, driver-table adapters
* ``operators``  - the six analytics (stage responsible, state durations,
                   first vs repeat, monthly growth, daily funnel, event paths), reports
                   on them and ordered paths
* ``plans``      - named query catalog, DuckDB oracle SQL, plan inspection
"""

from flowlens.operators.durations import sla_summary, state_durations, state_periods  # noqa: E402
from flowlens.operators.funnel import (  # noqa: E402
    active_users,
    daily_funnel,
    funnel_bitmaps,
    funnel_rollup,
    newest_leads,
    sales_after_registration,
)
from flowlens.operators.growth import cumulative_commission, monthly_growth  # noqa: E402
from flowlens.operators.paths import (  # noqa: E402
    DEFAULT_GRAPH,
    Edge,
    PathGraph,
    State,
    default_graph,
    event_paths,
)
from flowlens.operators.purchases import first_vs_repeat, purchase_numbers  # noqa: E402
from flowlens.operators.sequences import ordered_paths, ordered_steps  # noqa: E402
from flowlens.operators.transitions import forward_conversions, responsible_as_of, stage_responsible  # noqa: E402
from flowlens.sources.tables import publish, read_published, read_table  # noqa: E402

__all__ = [
    "DEFAULT_GRAPH", "Edge", "PathGraph", "State", "active_users", "cumulative_commission", "daily_funnel",
    "default_graph", "event_paths", "first_vs_repeat", "forward_conversions", "funnel_bitmaps", "funnel_rollup",
    "monthly_growth", "newest_leads", "ordered_paths", "ordered_steps", "publish", "purchase_numbers", "read_published",
    "read_table", "responsible_as_of", "sales_after_registration", "sla_summary", "stage_responsible",
    "state_durations", "state_periods",
]
