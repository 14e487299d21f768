"""The marts: one builder per published table."""
