"""Training-data operators (deduplication, tokens, packing, sharding, search).

Nothing else in the library imports this subpackage; its queries are in
``queries`` and its oracle SQL in ``oracle``.
"""
