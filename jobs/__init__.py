"""Runnable jobs: each a function that takes a session, and a command line."""
