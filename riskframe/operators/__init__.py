"""DataFrame-to-DataFrame operators."""
