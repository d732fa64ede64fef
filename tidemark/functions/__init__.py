"""Column expressions: text normalization, globs, identifiers, type names, versions, hashes."""
