"""Table-level operators: grid -> records, typing, silver, gold, reshape."""
