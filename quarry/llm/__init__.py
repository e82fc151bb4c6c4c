"""Operators for preparing large text corpora.

Each module holds one operator; ``queries`` registers one query per
operator.  Nothing outside this subpackage imports it.
"""
