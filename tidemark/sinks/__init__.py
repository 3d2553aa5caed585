"""Destination operations: keyed merge, versioned tables, audit rows."""
