"""Composite jobs over the zones (``zones``) and the query catalogue that
runs every operator on the shared test tables (``catalogue``)."""
