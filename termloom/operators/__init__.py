"""Corpus jobs: tokenise, build, merge, look up, rank."""
