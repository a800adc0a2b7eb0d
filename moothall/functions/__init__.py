"""Scalar functions as Column helpers: text, links, encodings, dates and numbers."""
