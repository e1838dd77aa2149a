"""Column functions: bits, collections, times and labels."""
