from medallion.operators.changelog import ChangeLog
from medallion.operators.compaction import compact_folder, write_sized
from medallion.operators.joins import hot_keys, hot_shares, spread_join

__all__ = ["ChangeLog", "compact_folder", "hot_keys", "hot_shares", "spread_join", "write_sized"]
