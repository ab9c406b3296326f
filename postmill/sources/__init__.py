"""Readers of address files and stores."""
