"""Operators put together: feature tables, training runs, the exploratory profile."""
