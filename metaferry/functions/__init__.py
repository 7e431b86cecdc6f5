"""Column expressions: text, whole-word renames, JSON documents, truth values."""
