"""Runnable jobs; each has a command line, a configuration file and a function ``run``."""
