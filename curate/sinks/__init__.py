from curate.sinks.files import (
    delete_folder,
    discard,
    move_folder,
    owned,
    shared_folder,
    stored,
    write_parquet,
    write_parts,
)
from curate.sinks.jdbc import load_jdbc

__all__ = [
    "delete_folder",
    "discard",
    "load_jdbc",
    "move_folder",
    "owned",
    "shared_folder",
    "stored",
    "write_parquet",
    "write_parts",
]
