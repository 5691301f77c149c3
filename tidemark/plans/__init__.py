"""Daily and hourly builds: gate, compute, overwrite, verify."""
