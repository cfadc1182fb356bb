"""riskloom streaming."""
