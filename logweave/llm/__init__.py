"""Training-data operators: sharding, scoring, de-duplication, decontamination, mixing.

Each module is one operator by one method; ``queries`` registers the digest
queries over the given tables.  Nothing else in the library imports this
subpackage.
"""
