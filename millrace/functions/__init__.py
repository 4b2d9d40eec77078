"""Column expressions: text classes, masking, metrics, prompts, JSON in prose."""
