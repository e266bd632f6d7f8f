"""Reading the landed files and writing results. Schemas are explicit; nothing is inferred."""
