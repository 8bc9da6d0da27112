"""Training-data operators: extraction, filters, de-duplication, formatting, packing and mixing.

Nothing else in the library imports this package; ``queries.py`` registers one query per operator.
"""
