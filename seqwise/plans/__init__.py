"""Composite plans: feature build, preparation, modelling."""
