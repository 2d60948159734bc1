"""A device fleet derived from the given tables, and every operator as a checkable query."""
