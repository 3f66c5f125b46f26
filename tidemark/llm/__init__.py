"""Operators for preparing training data: ten independent jobs over ``documents``-like tables."""
