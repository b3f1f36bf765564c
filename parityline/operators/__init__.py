"""DataFrame-in, DataFrame-out operators; none of them runs a job."""
