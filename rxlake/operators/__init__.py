"""DataFrame operators, one module per layer or concern."""
