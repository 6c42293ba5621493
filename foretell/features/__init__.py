"""Declarative column features with a fit/apply contract."""
