"""Training-data operators: near-duplicates, extraction, tokens, fingerprints,
quality, mixing, toxicity, archives, secrets, language.

Nothing outside this subpackage imports it.
"""
