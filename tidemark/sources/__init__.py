"""Extracts, configuration, listings, files, the master and the ledger."""
