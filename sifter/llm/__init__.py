"""Training-data operators. Nothing else in the library imports this
subpackage; ``queries.py`` lists its registered queries and their SQL."""
