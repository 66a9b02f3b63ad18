"""Lazy DataFrame transforms. Fitting (``training``) is the only module that runs jobs."""
