from tierflow.sinks.index import KeyIndex
from tierflow.sinks.marks import ConcurrentLoad, Mark, all_marks, current_mark, planned_window, read_mark, record_mark
from tierflow.sinks.tables import (
    Rows,
    add_partitions,
    append,
    check_schema,
    create_if_missing,
    current_version,
    insert_if_absent,
    load_name,
    overwrite_partitions,
    put_load,
    register,
    replace_distinct,
    replace_version,
)

__all__ = [name for name in dir() if not name.startswith("_")]
