"""Operators on DataFrames: page nodes and selectors, people, registry, runs, documents."""
