"""DataFrame to DataFrame operators. None of them has a side effect."""
