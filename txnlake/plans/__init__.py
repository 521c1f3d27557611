"""Named reports and the batch run."""
