from recflow.sinks.cache import push_lists, push_sorted_sets, to_list_rows, to_sorted_set_rows  # noqa: F401
from recflow.sinks.tables import write_snapshot, write_table  # noqa: F401
