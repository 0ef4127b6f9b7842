"""Operators of a training-data pipeline over text corpora.

Nothing else in the package imports this one; ``jobstar.llm.queries``
registers one query per operator.
"""
