"""Training-data operators: ten text operators, their queries and SQL twins."""
