"""DataFrame operators: layout detection, flattening, contracts, loads, checks."""
