"""Readers and writers: delivery discovery, multi-record text, nested XML, prepared tables and exports."""
