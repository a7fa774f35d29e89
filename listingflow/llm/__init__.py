"""Training-data operators: thirteen jobs over text corpora, their queries and their oracle SQL.

Nothing else in the library imports this subpackage.
"""
