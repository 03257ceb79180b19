"""Column-level functions: text cleaning, word lists and classification rules."""
