"""Scalar functions on names, titles, wiki markup and text."""
