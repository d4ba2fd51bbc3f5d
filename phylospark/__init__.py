"""PySpark operators for comparative-genomics tables."""
