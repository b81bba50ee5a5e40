"""Readers and writers: declared schemas, or types found out from all rows; single writes, or sets that commit as one."""

from .discovery import list_tree, write_tree  # noqa: F401
from .inference import infer_types, read_csv, read_documents_evolving  # noqa: F401
from .readers import (  # noqa: F401
    add_path_parts,
    list_paths,
    read_documents,
    read_files,
    read_ntriples,
    read_table,
    sidecar,
)
from .writers import create_tables, rebuild_tables, write_table  # noqa: F401
from .versions import commit, load_missing, manifest, partitions, read, vacuum  # noqa: F401
