"""Readers that turn files and foreign layouts into the flights table."""
