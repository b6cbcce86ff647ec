"""All registered queries."""

from . import (  # noqa: F401
    q_lifecycle,
    q_liveness,
    q_matching,
    q_scalars,
    q_settings,
    q_sources,
    q_streaming,
    q_tasks,
    q_views,
    q_windows,
)
from .registry import QUERIES, SQL  # noqa: F401
