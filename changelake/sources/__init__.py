"""Change files, notifications and epoch tables."""
