"""Composite flows and the registered queries over the supplied tables."""
