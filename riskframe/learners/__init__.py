"""Regressors trained by Spark jobs behind one interface, and cross-validation."""
