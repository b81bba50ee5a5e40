"""Incremental loads: batch insert-if-absent, file streams with a checkpoint, and checks."""

from .files import stream_new_files  # noqa: F401
from .incremental import (  # noqa: F401
    check_integrity,
    insert_absent,
    insert_children,
    partitions_to_build,
    run_metrics,
    table_counts,
)
from .ledger import load_files, loaded, stream_into  # noqa: F401
