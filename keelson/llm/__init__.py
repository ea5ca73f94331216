"""Training-data operators and the corpus pipeline.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
