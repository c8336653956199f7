"""Operators for preparing language-model training data: documents in, documents or judgements out."""
