"""Sessions, shared tables and the query registry."""
