"""Bronze, silver and gold builds, business questions and data checks."""
