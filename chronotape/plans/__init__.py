"""End-to-end jobs composed from operators, and the registered queries."""
