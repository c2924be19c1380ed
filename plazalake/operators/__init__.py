"""DataFrame -> DataFrame operators; no writes happen here.

The only actions are size checks before a broadcast and the scalars a caller
asks for by name (a date, a small contract table).
"""
