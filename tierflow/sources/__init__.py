from tierflow.sources.control import Spec, control_table, load_spec, load_specs
from tierflow.sources.files import (
    ARRIVED,
    LOAD,
    empty,
    event_stream,
    has_files,
    in_catalog,
    read_dimension,
    remembered_schema,
    snapshot,
    stored_schema,
    table_exists,
)
from tierflow.sources.relational import bounded, jdbc_options, query, read_table, slices, statement

__all__ = [name for name in dir() if not name.startswith("_")]
