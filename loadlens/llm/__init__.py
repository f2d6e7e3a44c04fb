"""Operators of a training-data pipeline: text, conversations, embeddings.

One module per operator plus helper modules (``tables``, ``texts``,
``graph``, ``exact``).  ``catalog`` holds the registered queries ``op1_..`` to
``op13_..`` and their SQL.  Nothing outside this subpackage imports it.
"""
