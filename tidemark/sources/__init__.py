"""Batch sources: tables, text files, archives, nested documents, series and change feeds."""
