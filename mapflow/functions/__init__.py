from .audit import RunContext, audit_values, source_flavour, target_flavour
from .expressions import col, quote, rewrite_main

__all__ = ["RunContext", "audit_values", "source_flavour", "target_flavour", "col", "quote", "rewrite_main"]
