"""ledgerly."""
