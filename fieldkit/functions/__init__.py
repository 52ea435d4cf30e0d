"""Column functions: rounding, distance, parsing and text formats."""
