"""Bronze, Silver and Gold processing of transaction events on Spark."""
