"""Operators for training-data pipelines: text, pages, vectors, dialogues and urls."""
