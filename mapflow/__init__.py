"""mapflow: mapping-driven warehouse loads as Spark DataFrame plans."""

from .functions.audit import RunContext
from .session import build_session, checkpoint_root, scratch_dir
from .sources.registry import TableRegistry, catalog_columns
from .sources.store import TableStore
from .spec import AUDIT_COLUMNS, ColumnSpec, JoinSpec, ModelSpec, TableRef

__all__ = [
    "AUDIT_COLUMNS", "ColumnSpec", "JoinSpec", "ModelSpec", "RunContext", "TableRef", "TableRegistry",
    "TableStore", "build_session", "catalog_columns", "checkpoint_root", "scratch_dir",
]
