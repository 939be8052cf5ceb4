"""Writers: table appends and overwrites, CSV extracts, keyed messages."""
