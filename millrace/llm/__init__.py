"""Operators a training-data pipeline needs: archives, text extraction, filtering, de-duplication, counting and mixing.

Nothing outside this folder and ``corpus_pipeline.py`` imports it. Operators take DataFrames and the names of their
columns, use no other column, and return new DataFrames. Two conventions hold everywhere:

* a document is a row; a null text counts as empty, a null ``doc_id`` as an id below all others;
* an extra column never clashes with a name used inside, because inner tables hold only the columns they need.
"""
