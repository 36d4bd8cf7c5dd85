"""Training-data operators: formatting, archives, token counts, mixing, filters, near duplicates.

Nothing outside this package imports it.  Each module holds one operator with
its own general interface; ``queries`` applies them to the given tables.
"""
