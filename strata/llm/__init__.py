"""Training-data operators: quality, language, tokens, rules, dedup, decontamination, mixing, sharding, HTML, licences.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` holds the registered queries.
"""
