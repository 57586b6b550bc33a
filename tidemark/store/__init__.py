from tidemark.store.table_store import (
    ConcurrentWrite,
    TableStore,
    WriteResult,
    sorted_for_write,
    with_partition_columns,
)

__all__ = ["ConcurrentWrite", "TableStore", "WriteResult", "sorted_for_write", "with_partition_columns"]
