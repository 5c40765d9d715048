"""Column-level helpers: quoting, schema checks, encodings and hash keys."""
