"""Operators for preparing training text: filters, deduplication, mixing and tokenizers.

Nothing else in the library imports this subpackage.
"""
