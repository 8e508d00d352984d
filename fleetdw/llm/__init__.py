"""Training-data operators: toxicity, token files, sharding, near-duplicates,
secrets, mixing, nearest neighbours, personal data and BPE coding.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
thin registered queries, ``oracle.py`` their SQL where SQL can express them.
"""
