"""Table sinks."""

from marquee.sinks.tables import (
    RefreshError, append, attach, create_table, create_view, full_refresh, hand_off, prune_versions, remove_path,
    write_jdbc,
)

__all__ = ["RefreshError", "append", "attach", "create_table", "create_view", "full_refresh", "hand_off",
           "prune_versions", "remove_path", "write_jdbc"]
