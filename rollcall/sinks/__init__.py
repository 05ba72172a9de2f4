"""Where reports and run records are written."""
