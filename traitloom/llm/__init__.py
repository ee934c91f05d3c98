"""Training-data operators: language ID, near-dedup, mixing, decontamination, token files and the like.

Nothing outside this subpackage imports it.
"""
