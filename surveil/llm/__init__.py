"""Training-data operators: one module per operator, their queries and SQL beside them."""
