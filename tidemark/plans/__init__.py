"""Whole flows: window planning and table synchronisation."""
