"""Operators for preparing training data.

Nothing outside this subpackage imports it; ``queries`` and ``oracle`` hold its
registered queries.
"""
