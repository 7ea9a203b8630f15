"""Operators for building training corpora; see the modules for each."""
