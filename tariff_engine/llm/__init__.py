"""Training-data operators: each module is one operator; `queries` registers them and their SQL.

Nothing outside this subpackage (and `corpus_pipeline.py`) imports it.
"""
