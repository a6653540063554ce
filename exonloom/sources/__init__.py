"""Readers: text, block and XML formats as distributed scans.

Every line format has a ``parse_*`` function over a ``value`` column and a
``read_*`` function over a path.
"""
