"""Commands for spark-submit; every path, format and threshold is an option."""
