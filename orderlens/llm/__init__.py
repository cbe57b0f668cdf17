"""Operators over text corpora. Nothing outside this folder imports them."""
