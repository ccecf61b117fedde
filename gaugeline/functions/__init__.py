"""Column expressions: row hashes, label vocabularies, operating modes, report arithmetic."""
