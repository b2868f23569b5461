"""Readers, writers and the adapter from the TPC-H style tables."""
