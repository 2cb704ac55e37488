"""Relational operators over records, statement items, catalogs and scores."""
