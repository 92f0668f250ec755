"""Column expressions: sequences, breakpoints, features, read pairs."""
