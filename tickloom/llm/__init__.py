"""Operators for large training-text corpora.

Self-contained: nothing outside this subpackage imports it, and removing the
folder leaves the rest of the library intact.
"""
