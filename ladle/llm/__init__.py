"""Training-data operators: one module per operator, their queries in :mod:`ladle.llm.queries`.

Nothing outside this folder (but for the entry module and ``corpus_pipeline.py``) imports it.
"""
