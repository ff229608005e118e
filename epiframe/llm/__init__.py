"""Training-data operators: dedup, media, quality, language, tokens, secrets, mixing.

Nothing else in the package imports this subpackage.
"""
