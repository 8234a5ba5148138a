"""Training-data operators: one module per operator, queries in ``registry``.

Nothing outside this package imports it (``corpus_pipeline.py`` at the
repository top counts as part of it); the rest of the library works without.
"""
