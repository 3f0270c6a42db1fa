"""Operators for preparing large text corpora, one module each, with their registered queries."""
