"""Operators of a large-scale training-data pipeline over a ``documents``
table (doc_id, text, lang, source, n_chars). Nothing else in the library
imports this subpackage."""
