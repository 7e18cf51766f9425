"""The plans bound to the TPC-H-like test tables, with their check SQL."""
