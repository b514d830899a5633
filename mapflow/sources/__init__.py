from .registry import TableRegistry, catalog_columns, catalog_listing, column_profile, schema_profile
from .store import CommitConflict, TableNotFound, TableStore

__all__ = ["CommitConflict", "TableRegistry", "TableStore", "TableNotFound", "catalog_columns", "catalog_listing",
           "column_profile", "schema_profile"]
