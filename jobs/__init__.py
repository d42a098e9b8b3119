"""Runnable jobs: a function that takes a session and plain paths, a command line, and a small configuration file each."""
