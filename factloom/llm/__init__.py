"""Training-data operators: ten self-contained operators and their queries.

Nothing outside this subpackage imports it.
"""
