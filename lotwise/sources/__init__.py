"""What the job reads and writes."""
