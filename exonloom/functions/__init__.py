"""Column functions: sequence, coordinate, alignment and naming expressions."""
