"""Jobs that chain operators from source tables to results."""
