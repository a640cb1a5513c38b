"""Operators for preparing training text: packing, fingerprints, formatting, sharding, cleaning."""
