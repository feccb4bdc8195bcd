"""Training-data operators: extraction, packing, de-duplication, tokens, search.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers them.
"""
