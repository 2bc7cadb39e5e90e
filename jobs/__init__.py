"""Runnable jobs over the given tables. Each is a function that takes a session, plain paths and a config; only the command line makes a session."""
