"""riskloom sources."""
