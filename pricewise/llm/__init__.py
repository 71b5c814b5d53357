"""Operators for preparing text corpora for model training.

Each operator module is a set of ``DataFrame -> DataFrame`` functions with a
general interface; :mod:`pricewise.llm.queries` registers one query per
operator over the given tables.
"""
