"""Operators of a training-data pipeline over documents, pages and embeddings. Nothing else imports this package."""
