"""Operators for the texts a language model is trained on."""
