"""Operators for training-data pipelines: packing, formatting, near-duplicates, mixing, extraction, filters, archives, personal data.

Nothing outside this subpackage imports it. Every operator is a function from DataFrames to DataFrames;
``queries`` holds the registered ``opN_*`` queries and ``sql`` the statements they are compared with.
"""
