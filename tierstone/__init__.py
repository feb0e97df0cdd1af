"""tierstone: multi-tenant raw -> standardised -> history -> serving tables on plain Spark."""

from tierstone.context import RunContext

__all__ = ["RunContext"]
