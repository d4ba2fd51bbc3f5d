"""Training-data operators: deduplication, extraction, encoding, scans and classifiers.

Nothing else in the library imports this subpackage.  Every operator takes DataFrames and
returns a DataFrame; the thin ``opN_*`` queries over the given tables live in
:mod:`phylospark.llm.queries`.
"""
