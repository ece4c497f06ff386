"""Set algebra, numbering, gates, quarantine, ledger analytics, reconciliation."""
