"""DataFrame-to-DataFrame operators of the retail engine."""
