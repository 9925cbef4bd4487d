"""Writers for run reports."""
