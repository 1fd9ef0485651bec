"""Operators for preparing language-model training data (documents, web pages, benchmarks)."""
