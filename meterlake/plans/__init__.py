"""Query plans over the gold star schema."""
