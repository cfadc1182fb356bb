"""riskloom plans."""
