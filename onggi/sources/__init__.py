"""Readers and writers of JSON lines, TSV pairs, text lines, tokenizer files and flagged outputs."""
