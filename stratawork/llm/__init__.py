"""Corpus preparation: near duplicates, mixing, tokens, packing, search and classifiers over text and vectors."""
