"""Registered queries (name -> callable) and their independent SQL oracles."""
