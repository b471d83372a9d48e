"""Training-data operators: token output, language and quality models, mixing, packing, dedup, search.

Nothing else in the library imports this subpackage. Each module is one operator with its own general
interface; ``queries.py`` holds the thin ``opN_<name>`` queries and the SQL they are checked against.
"""
