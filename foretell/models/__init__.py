"""Classifiers as Spark ML estimators."""
