"""Column expressions: parsing, casting, decoding, masking.  Nothing here runs Python per row."""
