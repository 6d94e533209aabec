"""Whole jobs made of the operators: reconcile a copy, load a table, keep marks and logs."""
