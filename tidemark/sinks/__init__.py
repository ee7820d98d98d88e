from .current import expire, merge_changes, read_current
from .evolve import read_evolved, write_evolving
from .table import checkpoint_path, console_rows, resolve_table_name, table_for, write_batch

__all__ = ["checkpoint_path", "console_rows", "expire", "merge_changes", "read_current", "read_evolved",
           "resolve_table_name", "table_for", "write_batch", "write_evolving"]
