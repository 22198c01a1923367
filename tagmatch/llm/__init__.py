"""Operators for building training data from documents, benchmarks and web pages."""
