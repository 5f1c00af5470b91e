"""Runnable jobs over the given tables. Each is a function of a session and paths; its command line makes and stops one."""
