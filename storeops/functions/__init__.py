"""Column-level helpers; all of them return Catalyst expressions, none runs Python per row."""
