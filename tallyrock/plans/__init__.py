"""The Silver and Gold jobs and the pipeline that runs them in order."""
