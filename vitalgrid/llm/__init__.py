"""Operators for preparing large text and embedding corpora; nothing outside this folder imports it."""
