"""Import-file and rebaseline exports."""
