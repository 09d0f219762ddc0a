from .temporal import arrival, latest_by_key, versions_by_key, temporal_join, temporal_semi_join
from .running import running, asof_count, asof_sum
from .ranking import rank_within, ranked_at, top_n, bottom_n, nest_ranked
from .lists import lists_after
from .materialize import discard, materialize

__all__ = ["arrival", "latest_by_key", "versions_by_key", "temporal_join", "temporal_semi_join",
           "running", "asof_count", "asof_sum", "rank_within", "ranked_at", "top_n", "bottom_n", "nest_ranked",
           "lists_after", "materialize", "discard"]
