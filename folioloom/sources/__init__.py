"""Source adapters: raw annotated documents to canonical tables."""
