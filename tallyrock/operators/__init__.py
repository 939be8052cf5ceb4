"""DataFrame-to-DataFrame steps; none of them starts a job."""
