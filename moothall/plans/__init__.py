"""Whole extractions: captured payloads in, rows of office-holders out."""
