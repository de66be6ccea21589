"""Operators for preparing large training corpora (documents, pages and embeddings).

Nothing outside this package imports it. Each module holds one operator with a general interface;
``queries`` registers the operators over the driver's tables.
"""
