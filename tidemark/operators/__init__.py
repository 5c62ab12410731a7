"""Relational verbs: names, filters, joins, aggregates, windows, sets, reshape, quality."""
