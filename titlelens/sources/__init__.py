"""Readers and writers of title records."""
