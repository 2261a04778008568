"""Operators of a training-data pipeline over ``documents``, ``benchmark`` and ``conversations``.

Nothing else in the library imports this package.  One module per operator; ``registry`` names the
queries, ``common`` holds the helpers they share (scratch tables, Arrow text access, hashing).
"""
