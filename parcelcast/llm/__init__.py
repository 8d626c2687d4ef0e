"""Operators for preparing training text; their queries are listed in ``registry``."""
