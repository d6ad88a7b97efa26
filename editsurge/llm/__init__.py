"""Training-data operators (documents, pages, embeddings)."""
