"""Operators for preparing training data at corpus scale.

Nothing else in ``postlake`` imports this subpackage. Each module holds one
operator with its own interface; ``queries`` holds the registered queries.
"""
