"""Operators for training corpora: documents in, documents or records out."""
