"""Continuous version of the drift monitor."""
