"""Reading raw tables and writing result tables."""
