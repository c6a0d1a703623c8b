"""Column expressions: text analysis and BM25F arithmetic."""
