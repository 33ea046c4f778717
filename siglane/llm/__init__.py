"""Training-data operators over a ``documents`` table; nothing else in the package imports this."""
