"""Training-data operators: mixing, filtering, classifying, searching, packing and joining text corpora.

Nothing outside this subpackage imports it. Every operator is a function from DataFrames to a DataFrame; the thin
digest queries over the standard tables are in ``queries``.
"""
