"""Landing files, catalog tables and the product reference."""
