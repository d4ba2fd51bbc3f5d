"""Table operators, one module for each kind of table."""
