"""DataFrame-level operators: each is a function usable with ``df.transform``."""
