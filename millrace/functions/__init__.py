"""Column builders: schema mapping, checks, decoding, partition transforms."""
