"""Training-data operators: ten corpus jobs over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing outside this subpackage imports it.  Each module holds one operator with a
general interface; ``queries.py`` derives the registered ``opN_*`` queries.
"""
