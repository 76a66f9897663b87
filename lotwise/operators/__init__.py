"""DataFrame-to-DataFrame steps, one module per part of the job."""
