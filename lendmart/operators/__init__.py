"""DataFrame-to-DataFrame operators: pure, lazy, no actions."""
