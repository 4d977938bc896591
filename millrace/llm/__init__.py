"""Training-data operators for text corpora at scale.

Each module holds one operator with a general interface; ``queries`` holds the
thin ``opN_<name>`` queries over the standard tables and their SQL.
"""
