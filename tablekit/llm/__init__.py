"""Operators for preparing training text: filters, scans, near duplicates, tokens, archives.

Nothing outside this folder imports it.  Every operator takes a DataFrame and
the names of its id and text columns, selects only those (so further columns,
whatever their names, are ignored) and returns a DataFrame.
"""
