"""riskloom operators."""
