"""Whole jobs: which operators run over which inputs, and where the results go."""
