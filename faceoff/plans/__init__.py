"""Job plans: refresh, and the named queries over the test tables."""
