"""Column expressions: text, hashing, declared types, DDL text, similarity."""
