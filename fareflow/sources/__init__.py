"""Readers for files, nested payloads and topics."""
