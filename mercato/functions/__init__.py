"""Column builders shared by the plans."""
