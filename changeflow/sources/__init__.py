"""Readers and decoders that produce the raw change table."""
