"""Training-data operators: archives, sharding, tokens, language, quality, search, packing and near-duplicates.

Nothing else in the library imports this subpackage.
"""
