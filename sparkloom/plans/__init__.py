"""User-facing jobs put together from the operators."""
