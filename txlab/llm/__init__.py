"""Operators that prepare a training corpus, one module each; ``queries`` binds them to the supplied tables."""
