"""DataFrame operators, for use directly or through ``DataFrame.transform``."""
