"""User-level jobs put together from the operators."""
