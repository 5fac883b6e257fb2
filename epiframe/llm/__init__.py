"""Operators for text corpora used in language-model training; nothing else in the library imports them."""
