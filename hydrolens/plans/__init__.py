"""Reports and batch jobs composed from the functions and operators."""
