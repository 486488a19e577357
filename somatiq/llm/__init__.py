"""Training-data operators over text corpora, embeddings, pages and conversations.

Nothing else in the library imports this subpackage.
"""
