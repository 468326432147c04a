"""Index tables: how they are derived, laid out, versioned and read back."""
