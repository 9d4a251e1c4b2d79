"""Training-data operators: thirteen corpus operators, their queries and SQL.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Every operator
takes a frame with ``doc_id`` and ``text`` and reads only those columns, so further
columns of any name never clash.
"""
