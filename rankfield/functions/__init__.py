"""Scalar functions: distances, date patterns, tokens and relevance scores."""
