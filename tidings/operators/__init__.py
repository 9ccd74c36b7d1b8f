"""Operators on DataFrames: keyed state, numbering, similarity, components, quality."""
