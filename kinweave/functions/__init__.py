"""Column functions: text, names, addresses and string similarity."""
