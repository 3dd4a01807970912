"""Operators for text that a language model is to be trained on. Nothing outside this subpackage imports it."""
