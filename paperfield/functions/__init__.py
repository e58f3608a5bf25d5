"""Column expressions: URLs, document content, retry arithmetic."""
