"""Readers, writers and the source views the jobs run on."""
