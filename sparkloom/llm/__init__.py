"""Training-data operators: one module per operator, queries and their SQL in ``queries``."""
