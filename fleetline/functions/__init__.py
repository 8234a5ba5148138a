"""Column-level functions: decoding, normalisation, validation, scalars."""
