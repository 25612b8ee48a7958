"""Operators that turn raw documents, pages and conversations into language-model training data."""
