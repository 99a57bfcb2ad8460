"""Plan shapes the operators are composed from."""
