"""Row-local steps over pages that keep landing."""
