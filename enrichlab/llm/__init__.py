"""Operators of a training-data pipeline: token counts, chat formatting, quality rules, byte-level
BPE, secret scans, benchmark decontamination, language id, MinHash near-dedup, a quality
classifier and repeated-passage detection.

Nothing outside this folder imports it (``corpus_pipeline.py`` at the repository top counts as
part of it).  Each module holds one operator with a general interface; ``queries.py`` holds the
thin registered queries.
"""
